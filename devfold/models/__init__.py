"""Demographic models as distributed Spark ML jobs."""
