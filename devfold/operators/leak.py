"""Ordering study: does the order of the device list give labels away?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devfold.operators.attributes import all_devices
from devfold.operators.joins import spread_join
from devfold.operators.positions import numbered

COLUMNS = ["device_id", "phone_brand", "device_model", "gender", "age", "grp"]


def first_event(events: DataFrame) -> DataFrame:
    """Lowest event id per device."""
    return events.groupBy("device_id").agg(F.min("event_id").alias("event"))


def leak_devices(train: DataFrame, test: DataFrame, phones: DataFrame) -> DataFrame:
    """Labelled and unlabelled devices with each of their phone rows."""
    return spread_join(phones, all_devices(train, test), "device_id").select(*COLUMNS)


def leak_table(
    train: DataFrame, test: DataFrame, phones: DataFrame, events: DataFrame
) -> DataFrame:
    """Devices with phone and first event, ordered by brand, model and device.

    The first event joins the device list while both have one row per device; the
    phone rows, which may repeat, come last. Repeated rows have equal sort keys, and
    equal keys share a range partition, so the scan position breaks ties: the order
    of identical rows is immaterial, but a large group of them gets split.
    """
    devices = all_devices(train, test).join(first_event(events), "device_id", "left")
    # rows are dealt by their own columns: a retried scan may number them anew
    joined = spread_join(_numbered(phones), devices, "device_id", sample=phones, stable=phones.columns)
    ordered = joined.orderBy("phone_brand", "device_model", "device_id", "_at")
    return ordered.select(*COLUMNS, "event")


def leak_positions(
    train: DataFrame, test: DataFrame, phones: DataFrame, events: DataFrame
) -> DataFrame:
    """The rows of :func:`leak_table` with their place in its order, from 1; rows alike in all keys follow in any order."""
    devices = all_devices(train, test).join(first_event(events), "device_id", "left")
    joined = spread_join(phones, devices, "device_id").select(*COLUMNS, "event")
    return numbered(joined, ["phone_brand", "device_model", "device_id"])


def _numbered(phones: DataFrame) -> DataFrame:
    return phones.withColumn("_at", F.monotonically_increasing_id())
