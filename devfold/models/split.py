"""Train and validation splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devfold.functions import hash_bucket

BUCKETS = 10_000


def hash_split(
    df: DataFrame, fraction: float = 0.9, seed: int = 0, key: str = "device_id"
) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the key: the same rows on every run, layout and retry."""
    part = hash_bucket(key, BUCKETS, seed)
    cut = round(fraction * BUCKETS)
    return df.where(part < cut), df.where(part >= cut)


def with_fold(df: DataFrame, folds: int, seed: int = 0, key: str = "device_id") -> DataFrame:
    """Add a ``fold`` number 0..folds-1, stable per key."""
    return df.withColumn("fold", (hash_bucket(key, BUCKETS, seed) % folds).cast("int"))
