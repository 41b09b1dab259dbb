"""Named queries and their reference SQL."""
