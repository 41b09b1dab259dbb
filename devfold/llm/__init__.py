"""Operators for preparing training text, each one a Spark job of its own."""
