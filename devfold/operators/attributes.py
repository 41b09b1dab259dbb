"""Who a device is: demographics and phone, one row per device."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devfold.functions import encode_gender

DEMOGRAPHICS = {"gender": "string", "age": "int", "grp": "string"}


def _one_row_each(df: DataFrame, columns: list[str]) -> DataFrame:
    """One whole row per device (the smallest), combined map-side."""
    picked = df.groupBy("device_id").agg(F.min(F.struct(*columns)).alias("_row"))
    return picked.select("device_id", "_row.*")


def device_attributes(devices: DataFrame, phones: DataFrame) -> DataFrame:
    """Devices with a known phone; repeated entries on either side collapse before the join.

    Both sides end up hashed by ``device_id``, so the join adds no shuffle.
    """
    people = _one_row_each(devices, list(DEMOGRAPHICS))
    handsets = _one_row_each(phones, ["phone_brand", "device_model"])
    return people.join(handsets, "device_id").select(
        "device_id", "gender", "age", "phone_brand", "device_model", "grp"
    )


def base_attributes(devices: DataFrame, phones: DataFrame) -> DataFrame:
    """Device attributes under profile names, gender as a code."""
    return device_attributes(devices, phones).select(
        "device_id",
        encode_gender("gender").alias("gender"),
        "age",
        F.col("phone_brand").alias("brand"),
        F.col("device_model").alias("model"),
        "grp",
    )


def with_missing_labels(devices: DataFrame) -> DataFrame:
    """Unlabelled devices with typed, missing demographics."""
    return devices.select("device_id", *_missing())


def _missing() -> list[Column]:
    return [F.lit(None).cast(kind).alias(name) for name, kind in DEMOGRAPHICS.items()]


def unlabelled_profile(test: DataFrame, phones: DataFrame) -> DataFrame:
    """Attributes of unlabelled devices: the phone is known, the person is not."""
    return device_attributes(with_missing_labels(test), phones)


def all_devices(train: DataFrame, test: DataFrame) -> DataFrame:
    """Distinct union of labelled and unlabelled devices."""
    columns = ["device_id", *DEMOGRAPHICS]
    return train.select(columns).unionByName(with_missing_labels(test)).distinct()
