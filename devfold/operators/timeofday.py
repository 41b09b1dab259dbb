"""Time-of-day patterns: events per device and slice, long and wide."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devfold.functions import time_slice
from devfold.operators.features import Block, widen
from devfold.schemas import SLICES, FeatureSpace


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows in which every field is missing."""
    return df.dropna(how="all")


def events_with_slice(events: DataFrame, minutes: int = 10) -> DataFrame:
    """Events with their timestamp replaced by the slice of the day."""
    return drop_empty_rows(events).select(
        "event_id",
        "device_id",
        time_slice("ts", minutes).alias("slice"),
        "longitude",
        "latitude",
    )


def device_slice_counts(events: DataFrame, minutes: int = 10) -> DataFrame:
    """Events per device and slice; events without a time count under a null slice."""
    return (
        drop_empty_rows(events.select("device_id", "ts"))
        .groupBy("device_id", time_slice("ts", minutes).alias("slice"))
        .agg(F.count(F.lit(1)).alias("c"))
    )


def time_histogram(slice_counts: DataFrame, slices: int = SLICES) -> DataFrame:
    """One row per device with ``t1..t{slices}``, 0 where the device has no event."""
    return widen(slice_counts, "slice", "c", {i: f"t{i}" for i in range(1, slices + 1)})


def time_block(slice_counts: DataFrame, slices: int = SLICES) -> Block:
    names = FeatureSpace(slices=slices).slice_names
    return Block(slice_counts, "c", names, key="slice", first=1)
