"""Relational operators over device, event, app and label frames."""
