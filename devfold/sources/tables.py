"""CSV and Parquet tables, and fitted models on storage."""

from __future__ import annotations

import time

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from devfold.schemas import TIMESTAMP_FORMAT, FeatureSpace, table_schema


def read_table(
    spark: SparkSession, path: str, name: str, space: FeatureSpace = FeatureSpace()
) -> DataFrame:
    """Scan one of the known tables with its fixed schema (CSV unless the path ends in .parquet)."""
    reader = spark.read.schema(table_schema(name, space))
    if path.rstrip("/").endswith(".parquet"):
        return reader.parquet(path)
    reader = reader.option("timestampNTZFormat", TIMESTAMP_FORMAT)
    return reader.csv(path, header=True, sep=",")


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV scan with inferred types (costs one more pass over the file)."""
    return spark.read.csv(path, header=True, inferSchema=True)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Distributed CSV sink with a header in every part file."""
    writer = df.write.mode(mode).option("timestampNTZFormat", TIMESTAMP_FORMAT)
    writer.csv(path, header=True)


def save_model(model: PipelineModel, path: str, stamp: bool = False) -> str:
    """Store a fitted pipeline; ``stamp`` appends the time in milliseconds to the name."""
    if stamp:
        path = f"{path}{int(time.time() * 1000)}"
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
