"""Device profiles on Spark: activity logs in, demographic scores out."""
