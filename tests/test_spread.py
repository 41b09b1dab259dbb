"""Steps under the model frames that move or sort less than they did, held against plain results."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from devfold.models import fit
from devfold.models.vectors import block_vectors
from devfold.operators import joins, labels

from .test_models import CLASSES, frames  # noqa: F401
from .test_skew import no_broadcast, skewed  # noqa: F401


def test_vectors_need_no_lists_and_devices_span_batches(spark):
    rows = [(d, k, float(d + k)) for d in range(1, 40) for k in range(d % 11)] + [(7, None, 1.0), (50, None, 1.0), (51, 3, None), (None, 2, 4.0)]
    counts = spark.createDataFrame(rows[::-1], "device_id long, k int, n double").repartition(5)
    want = {}
    for device, at, value in rows:
        own = want.setdefault(device, [0.0] * 11)
        if at is not None and value is not None:
            own[at] = value
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        vectors = block_vectors(counts, F.col("k"), "n", 11, "v")
        found = vectors.collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert {r.device_id: r.v.toArray().tolist() for r in found} == want and len(found) == len(want)
    assert all((np.diff(r.v.indices) > 0).all() for r in found)
    assert "collect_list" not in vectors._jdf.queryExecution().executedPlan().toString()


def test_counts_of_a_device_are_dealt_once(spark, skewed):  # noqa: F811
    uses, events, tags = skewed
    vectors = block_vectors(labels.device_label_counts(tags, uses, events), F.col("label_id"), "ile", 60, "labels")
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(device_id") == 2  # the distinct pairs and the counts


def test_hot_and_cold_ids_of_one_hash_stay_apart(spark):
    hot = spark.range(20_000).select(F.lit(7).cast("long").alias("k"), F.col("id").alias("v"))
    # cold ids that look like the hash of the hot one and a salt
    hashes = spark.range(joins.SALTS).select(F.xxhash64(F.lit(7).cast("long"), F.col("id").cast("int")).alias("k"), F.lit(-1).cast("long").alias("v"))
    many = spark.range(100_000).select((F.col("id") + 1000).alias("k"), F.col("id").alias("v"))
    nulls = spark.createDataFrame([(None, -2)], "k long, v long")
    big = hot.unionByName(hashes).unionByName(many).unionByName(nulls)
    small = spark.createDataFrame([(7, 1), (7, 2), (1000, 3)], "k long, w long").unionByName(hashes.select("k", F.lit(9).cast("long").alias("w")))
    with no_broadcast(spark):
        joined = joins.spread_join(big, small, "k")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.columns == ["k", "v", "w"] and "Sort [_salted" in plan and ", _salt#" not in plan.split("Sort [")[1].split("]")[0]
        assert joined.groupBy("w").count().collect() and {tuple(r) for r in joined.groupBy("w").count().collect()} == {(1, 20_000), (2, 20_000), (3, 1), (9, joins.SALTS)}
        left = joins.spread_join(big, small, "k", how="left")
        assert left.count() == 40_000 + joins.SALTS + 100_000 + 1 and left.where("w is null").count() == 100_000


def test_perceptron_reads_inputs_written_once_in_even_tasks(spark, frames, monkeypatch):  # noqa: F811
    _, filled, _ = frames
    labelled = fit.with_label(filled, classes=CLASSES)
    inputs = fit.Inputs(("labels", "time"), ("allev", "nolat"))
    _, plain = fit._prepared(labelled, inputs, True, True)
    monkeypatch.setattr(fit, "TASK_ROWS", 40)
    model, ready = fit._scaled(labelled, inputs)
    assert 2 <= len(ready.inputFiles()) <= -(-labelled.count() // 40)
    want = {r.device_id: r.features.toArray() for r in plain.select("device_id", "features").collect()}
    for found in (ready, model.transform(labelled.withColumns({c: F.col(c).cast("double") for c in inputs.numbers}))):
        got = {r.device_id: r.features.toArray() for r in found.select("device_id", "features").collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    assert fit._width(ready) == len(next(iter(want.values())))
