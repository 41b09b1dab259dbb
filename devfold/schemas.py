"""Column layouts of the source tables and of the generated wide tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Table layouts of the input files. Ids are 64-bit and signed.
TABLES = {
    "gender_age_train": "device_id BIGINT, gender STRING, age INT, grp STRING",
    "gender_age_test": "device_id BIGINT",
    "phone_brand_device_model": "device_id BIGINT, phone_brand STRING, device_model STRING",
    "events": "event_id BIGINT, device_id BIGINT, ts TIMESTAMP_NTZ, longitude DOUBLE, latitude DOUBLE",
    "app_events": "event_id BIGINT, app_id BIGINT, is_installed INT, is_active INT",
    "app_labels": "app_id BIGINT, label_id INT",
    "label_categories": "label_id INT, category STRING",
}

# Format of the event timestamp text.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# The demographic classes, in submission order.
CLASSES = [
    "F23-", "F24-26", "F27-28", "F29-32", "F33-42", "F43+",
    "M22-", "M23-26", "M27-28", "M29-31", "M32-38", "M39+",
]

# Label ids run 1..1021, ten-minute slices 1..144, clusters 0..999.
LABELS = 1021
SLICES = 144
CLUSTERS = 1000

ATTRIBUTES = ["device_id", "gender", "age", "brand", "model", "grp"]
TOTALS = ["allev", "nolat"]


@dataclass(frozen=True)
class FeatureSpace:
    """The named feature blocks of a profile; every size is a parameter."""

    labels: int = LABELS
    slices: int = SLICES
    clusters: int = CLUSTERS

    @property
    def label_names(self) -> list[str]:
        return [str(i) for i in range(1, self.labels + 1)]

    @property
    def slice_names(self) -> list[str]:
        return [f"t{i}" for i in range(1, self.slices + 1)]

    @property
    def cluster_names(self) -> list[str]:
        return [f"c{i}" for i in range(self.clusters)]

    @property
    def names(self) -> list[str]:
        return self.label_names + self.slice_names + TOTALS + self.cluster_names


def table_schema(name: str, space: FeatureSpace = FeatureSpace()) -> T.StructType:
    """Schema of a source table or of a generated wide table."""
    if name in TABLES:
        return T.StructType.fromDDL(TABLES[name])
    empty = [
        T.StructField("device_id", T.LongType()),
        T.StructField("gender", T.IntegerType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("brand", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("grp", T.StringType()),
    ]
    counts = {
        "time_histogram": space.slice_names,
        "cluster_histogram": space.cluster_names,
        "base_profile": space.label_names,
        "full_profile": space.label_names + space.slice_names,
        "all_profile": space.names,
        "empty_profile": [],
    }
    if name not in counts:
        raise KeyError(f"unknown table: {name}")
    keys = empty if name.endswith("_profile") else empty[:1]
    return T.StructType(keys + [T.StructField(c, T.LongType()) for c in counts[name]])
