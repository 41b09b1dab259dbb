"""Results stay whole and plans stay balanced when one key holds a third of the rows."""

from __future__ import annotations

import contextlib

import pytest
from pyspark.sql import functions as F

from devfold.operators import attributes, joins, labels, leak, location, timeofday


@contextlib.contextmanager
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@pytest.fixture(scope="module")
def skewed(spark):
    """App events where one event, one app and one device each hold a third."""
    ids = spark.range(60_000)
    third = F.col("id") % 3 == 0
    uses = ids.select(
        F.when(third, 5).otherwise(F.col("id") % 4000).alias("event_id"),
        F.when(F.col("id") % 3 == 1, 11).otherwise(F.pmod(F.hash("id"), F.lit(900))).cast("long").alias("app_id"),
    )
    events = spark.range(4000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 300).alias("device_id"),
    )
    repeated = events.unionByName(events.where("event_id = 5").withColumn("_x", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("_x"))
    tags = spark.range(900).select(
        F.col("id").alias("app_id"), F.explode(F.array(F.col("id") % 40 + 1, F.col("id") % 7 + 50)).alias("label_id")
    )
    return uses, repeated, tags


def _plain(uses, events, tags):
    a, e, t = uses.toPandas(), events.toPandas(), tags.toPandas()
    triples = a.merge(e).merge(t)[["device_id", "label_id", "app_id"]].drop_duplicates()
    counts = triples.groupby(["device_id", "label_id"]).size()
    return {(d, l, n) for (d, l), n in counts.items()}


def test_label_counts_by_brute_force(spark, skewed):
    uses, events, tags = skewed
    expected = _plain(uses.distinct(), events.distinct(), tags)
    found = {tuple(r) for r in labels.device_label_counts(tags, uses, events).collect()}
    assert found == expected
    with no_broadcast(spark):
        salted = labels.device_label_counts(tags, uses, events)
        assert "_salt" in salted._jdf.queryExecution().toString()
        assert {tuple(r) for r in salted.collect()} == expected


def test_hot_keys_are_found_and_spread(spark):
    big = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    hot = spark.range(1).select(joins.hot_keys(big, "k").alias("h")).head()[0]
    assert 7 in hot and len(hot) <= joins.HOT_KEYS
    small = spark.range(200_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    with no_broadcast(spark):
        joined = joins.spread_join(big, small, "k")
        plan = joined._jdf.queryExecution().toString()
        assert "_salt" in plan and "CartesianProduct" not in plan
        assert joined.count() == 200_000
        left = joins.spread_join(big, small.where("k % 2 = 0"), "k", how="left")
        assert left.count() == 200_000
        assert left.where("w is null").count() == big.where("k % 2 = 1").count()


def test_spread_join_rejects_other_kinds(spark):
    df = spark.range(3)
    with pytest.raises(ValueError, match="inner, left"):
        joins.spread_join(df, df, "id", how="right")


def test_string_and_null_keys(spark):
    big = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "k string, v int")
    small = spark.createDataFrame([("a", 10), ("c", 20)], "k string, w int")
    with no_broadcast(spark):
        found = joins.spread_join(big, small, "k", how="left")
        assert {(r.k, r.v, r.w) for r in found.collect()} == {
            ("a", 1, 10), ("a", 2, 10), (None, 3, None), ("b", 4, None),
        }


def test_null_keys_are_dealt_out(spark):
    big = spark.range(200_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    small = spark.range(200_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    with no_broadcast(spark):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            joined = joins.spread_join(big, small, "k", how="left")
            sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 200_000 and max(sizes) < 2 * sum(sizes) / len(sizes)
            assert joined.where("w is null").count() == big.where("k is null").count()
            assert joins.spread_join(big, small, "k").count() == big.where("k is not null").count()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_repeated_phone_rows_are_kept_and_split(spark):
    phones = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("device_id"),
        F.lit("A").alias("phone_brand"),
        F.lit("a").alias("device_model"),
    )
    train = spark.range(30_000).select(
        F.col("id").alias("device_id"), F.lit("F").alias("gender"),
        F.lit(30).alias("age"), F.lit("F29-32").alias("grp"),
    )
    test = spark.range(0).withColumnRenamed("id", "device_id")
    events = spark.range(10).select(F.col("id").alias("event_id"), F.col("id").alias("device_id"))
    with no_broadcast(spark):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            found = leak.leak_table(train, test, phones, events)
            sizes = found.groupBy(F.spark_partition_id()).count().agg(F.max("count")).head()[0]
            assert found.count() == 30_000
            assert sizes < 10_000
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert attributes.device_attributes(train, phones).where("device_id = 1").count() == 1


def _exchanges(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_pivot_buffers_are_not_shuffled(spark):
    events = spark.range(1000).select(
        F.col("id").alias("event_id"), (F.col("id") % 9).alias("device_id"),
        F.lit("2016-05-01 00:00:00").cast("timestamp_ntz").alias("ts"),
    )
    plan = _exchanges(timeofday.time_histogram(timeofday.device_slice_counts(events)))
    wide, counts = plan.split("Exchange", 1)
    assert "partial_pivotfirst" in wide and "pivotfirst" not in counts
    assert plan.count("Exchange hashpartitioning") == 2


def test_counting_is_combined_before_the_shuffle(spark):
    events = spark.range(1000).select((F.col("id") % 9).alias("device_id"))
    plan = _exchanges(location.events_per_device(events))
    assert "partial_count" in plan.split("Exchange", 1)[1]
