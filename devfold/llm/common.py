"""What several text operators share: input columns, batch sizes, shared-folder tables."""

from __future__ import annotations

import ctypes

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from devfold.session import materialize

_LIBC = ctypes.CDLL(None)
#: Rows and bytes in one Arrow batch. Texts are long, so Spark's default number of rows is too many.
BATCH_ROWS = 5000
BATCH_BYTES = 6 << 20
#: Bytes in one batch where stages follow each other in the same workers, which hold what earlier ones left.
STAGE_BATCH_BYTES = 2 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One whole input table."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Bound what one Arrow batch of texts holds, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def running_total(df: DataFrame, key: str, value: str, out: str, block: int = 4096) -> DataFrame:
    """Sum of ``value`` over all rows with a smaller ``key``; keys are small distinct integers.

    Two levels, so no task sees more than ``block`` rows or one row for each block.
    """
    cut = df.withColumn("_block", F.floor(F.col(key) / block))
    whole = cut.groupBy("_block").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_earlier"))
    inside = Window.partitionBy("_block").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    summed = cut.withColumn("_own", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return summed.join(whole, "_block").withColumn(out, (F.col("_own") + F.col("_earlier")).cast("long")).drop("_block", "_own", "_earlier")


def release() -> None:
    """Give freed memory back to the system, so that idle workers stay small beside the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_LIBC, "malloc_trim", None)
    if trim:
        trim(0)


def id_and_text(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns that the text operators read; other columns stay behind."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front of it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, safe from lost executors."""
    return materialize(df)


def ranges_of(docs: DataFrame, target_bytes: int) -> tuple[list[int], int]:
    """Cut points of ``doc_id`` that make consecutive groups of about ``target_bytes`` of text.

    One row comes back: quantiles, count and size. The number of cuts grows with the
    text over ``target_bytes`` (eight bytes for each).
    """
    row = docs.agg(F.count("doc_id").alias("n"), F.sum(F.octet_length("text")).alias("size")).first()
    rows, size = row["n"] or 0, row["size"] or 0
    groups = max(1, min(rows, -(-size // target_bytes)))
    if groups < 2:
        return [], size
    # shares have to be a constant for the aggregate: one literal that is split and cast, however many they are
    shares = F.split(F.lit(",".join(repr(i / groups) for i in range(1, groups))), ",").cast("array<double>")
    cuts = docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * groups)).alias("cuts")).first()["cuts"]
    return sorted(set(cuts)), size


def group_of(cuts: list[int], key: str = "doc_id") -> Column:
    """Index of the group that holds a key, ascending with the key; nulls come first."""
    if not cuts:
        return F.lit(0)
    bounds = np.array(cuts, np.int64)

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, keys.to_numpy()).astype(np.int32))

    return place(F.coalesce(F.col(key), F.lit(-(2**63))))
