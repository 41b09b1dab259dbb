"""Device populations: with activity, without, and all; set operations and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devfold.schemas import ATTRIBUTES


def distinct_devices(df: DataFrame) -> DataFrame:
    return df.select("device_id").distinct()


def active_devices(base: DataFrame, active: DataFrame) -> DataFrame:
    """Base rows of devices that occur in ``active``."""
    return base.join(distinct_devices(active), "device_id", "left_semi")


def full_profile(base: DataFrame, histogram: DataFrame) -> DataFrame:
    """Devices with activity: base profile and time histogram."""
    return base.join(histogram, "device_id")


def empty_profile(base: DataFrame, active: DataFrame) -> DataFrame:
    """Devices without activity, attributes only.

    ``active`` is any frame with a ``device_id``; it is reduced to distinct ids
    first, so an active device with many rows is shuffled once.
    """
    idle = base.where("device_id is not null").join(
        distinct_devices(active), "device_id", "left_anti"
    )
    return idle.select(*ATTRIBUTES)


def devices_without_events(base: DataFrame, active: DataFrame) -> DataFrame:
    """Distinct ids in ``base`` that ``active`` lacks (null-safe set difference)."""
    return base.select("device_id").subtract(distinct_devices(active))


def all_profile(
    base: DataFrame,
    histogram: DataFrame,
    allev: DataFrame,
    nolat: DataFrame,
    clusters: DataFrame,
) -> DataFrame:
    """Every base device with all blocks; a block the device lacks is null.

    For frames that are wide already. All have one row per device and are hashed by
    it, so the chain of joins adds no shuffle; from counts, ``attach_blocks`` gets
    there without joining wide rows.
    """
    return (
        base.join(histogram, "device_id", "left")
        .join(allev.select("device_id", "allev"), "device_id", "left")
        .join(nolat.select("device_id", "nolat"), "device_id", "left")
        .join(clusters, "device_id", "left")
    )


def reconcile(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows and distinct devices on both sides of a step, as two rows."""

    def counts(df: DataFrame, side: str) -> DataFrame:
        per_device = df.groupBy("device_id").agg(F.count(F.lit(1)).alias("rows"))
        return per_device.agg(
            F.lit(side).alias("side"),
            F.coalesce(F.sum("rows"), F.lit(0).cast("bigint")).alias("n_rows"),
            F.count("device_id").alias("n_devices"),
        )

    return counts(a, "in").unionByName(counts(b, "out"))


def peek(df: DataFrame, by: list[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*by).limit(n)
