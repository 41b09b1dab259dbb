"""Which app labels a device shows, as long counts, strings and a matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devfold.functions import group_concat, label_map
from devfold.operators.features import Block, attach_blocks
from devfold.operators.joins import spread_join
from devfold.schemas import LABELS, FeatureSpace


def device_apps(app_events: DataFrame, events: DataFrame) -> DataFrame:
    """Distinct ``(device_id, app_id)``.

    Both inputs are reduced to distinct pairs before they meet: an event repeated
    many times in either table would otherwise multiply in the join.
    """
    used = app_events.select("event_id", "app_id").where("app_id is not null").distinct()
    owners = events.select("event_id", "device_id").distinct()
    pairs = spread_join(used, owners, "event_id", sample=app_events)
    return pairs.select("device_id", "app_id").distinct()


def device_label_apps(
    labels: DataFrame, app_events: DataFrame, events: DataFrame
) -> DataFrame:
    """Distinct ``(device_id, label_id, app_id)`` of labels, app events and events.

    Device-app pairs and app-label pairs are each distinct, so their join is too:
    the exploded result needs no further distinct.
    """
    pairs = device_apps(app_events, events)
    tags = labels.select("app_id", "label_id").distinct()
    joined = spread_join(pairs, tags, "app_id", sample=app_events)
    return joined.select("device_id", "label_id", "app_id")


def device_label_counts(
    labels: DataFrame, app_events: DataFrame, events: DataFrame
) -> DataFrame:
    """Number of apps per device and label.

    The triples are distinct, so adding up before the shuffle would merge few of them, and a device has at most
    as many as the dictionary: they are dealt by device and counted there, which leaves the counts of a device together.
    """
    return (
        device_label_apps(labels, app_events, events)
        .repartition("device_id")
        .groupBy("device_id", "label_id")
        .agg(F.count("app_id").alias("ile"))
    )


def device_label_long(attributes: DataFrame, label_counts: DataFrame) -> DataFrame:
    """Attributes with one row per label of the device, one null row where it has none."""
    return attributes.join(label_counts, "device_id", "left")


def device_label_strings(label_counts: DataFrame) -> DataFrame:
    """Labels and their counts as two comma-joined strings in label order.

    A group has at most one row per label, however many events the device has.
    """
    return label_counts.groupBy("device_id").agg(
        group_concat("label_id", order_by="label_id").alias("labels"),
        group_concat("ile", order_by="label_id").alias("iles"),
    )


def parse_label_list(strings: DataFrame) -> DataFrame:
    """The two strings of each device back to ``(device_id, label_id, ile)`` rows."""
    return strings.select("device_id", F.explode(label_map("labels", "iles"))).select(
        "device_id", F.col("key").alias("label_id"), F.col("value").alias("ile")
    )


def label_block(label_counts: DataFrame, labels: int = LABELS) -> Block:
    names = FeatureSpace(labels=labels).label_names
    return Block(label_counts, "ile", names, key="label_id", first=1)


def label_matrix(
    attributes: DataFrame, label_counts: DataFrame, labels: int = LABELS
) -> DataFrame:
    """Base profile: attributes and one count column per label id 1..labels.

    Absent labels are 0; the whole block is null for a device without label rows.
    """
    return attach_blocks(attributes, label_block(label_counts, labels))


def label_categories(categories: DataFrame) -> DataFrame:
    """Label dictionary with one category per label."""
    return categories.groupBy("label_id").agg(F.min("category").alias("category"))


def with_category(labels: DataFrame, categories: DataFrame) -> DataFrame:
    """Label rows with their category, null where the dictionary has none.

    No hint: the dictionary is broadcast when its measured size allows it.
    """
    return spread_join(labels, label_categories(categories), "label_id", how="left")


def label_category_counts(app_labels: DataFrame, categories: DataFrame) -> DataFrame:
    """Distinct labels and label assignments per category.

    Assignments are counted per label first, so the join sees one row per label.
    """
    per_label = app_labels.groupBy("label_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        with_category(per_label, categories)
        .groupBy("category")
        .agg(F.count("label_id").alias("n_labels"), F.sum("n").alias("n_apps"))
    )
