"""Global row numbers, level codes, slots for rare levels, furthest starts, scaled wide profiles."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from devfold.models import fit
from devfold.operators import features, leak, location
from devfold.operators.features import Block
from devfold.operators.positions import numbered
from devfold.schemas import FeatureSpace
from tests.conftest import rows


def test_numbers_follow_the_order(spark):
    rng = random.Random(2)
    data = [(rng.choice([None, *"abcdefgh"]), rng.randrange(40)) for _ in range(3000)]
    df = spark.createDataFrame(data, "place string, at int").repartition(13)
    got = numbered(df, ["place", "at"], "n")
    assert got.columns == ["place", "at", "n"]
    found = sorted((r.n, r.place, r["at"]) for r in got.collect())
    assert [n for n, _, _ in found] == list(range(1, 3001))
    assert [(p, a) for _, p, a in found] == sorted(data, key=lambda r: (r[0] is not None, r[0] or "", r[1]))


def test_a_third_of_equal_keys_is_split(spark):
    """Every partition of the sort holds at most twice the mean."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
        got = numbered(df, ["k"])
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) <= 2 * 30_000 / 8
        assert got.where("k = 0").agg(F.min("position"), F.max("position")).head()[:] == (1, 10_000)
        assert got.agg(F.count_distinct("position")).head()[0] == 30_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_numbering_nothing(spark):
    empty = spark.createDataFrame([], "k int")
    assert numbered(empty, ["k"]).collect() == []
    assert features.level_codes(empty, "k").collect() == []


def test_leak_positions(tables):
    got = leak.leak_positions(tables["gender_age_train"], tables["gender_age_test"], tables["phone_brand_device_model"], tables["events"])
    order = [r.device_id for r in got.orderBy("position").collect()]
    assert order[0] < order[1] and order[1:] == [4, 2, 2, 3]


def test_codes_of_many_levels(spark):
    df = spark.range(200_000).select(F.when(F.col("id") % 3 > 0, F.concat(F.lit("l"), F.pmod(F.xxhash64("id"), F.lit(10**9)))).alias("c"))
    got = features.index_categories(df, ["c"])
    levels = sorted({r.c for r in df.where("c is not null").collect()})
    codes = {level: float(i) for i, level in enumerate(levels)}
    assert got.count() == 200_000
    found = {(r.c, r.c_idx) for r in got.distinct().collect()}
    assert found == {*codes.items(), (None, float(len(levels)))}


def test_codes_equal_the_indexer(spark):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(["b", "a", None, "ä", "B", "b", "", "a b"])], "c string, n int")
    got = {(r.n, r.c_idx) for r in features.index_categories(df, ["c"]).collect()}
    wanted = features.category_indexer(["c"]).fit(df).transform(df)
    assert got == {(r.n, r.c_idx) for r in wanted.collect()}


def test_rare_levels_share_slots(spark, monkeypatch):
    monkeypatch.setattr(fit, "MOST_LEVELS", 3)
    monkeypatch.setattr(fit, "SLOTS", 4)
    names = ["it's", "back\\slash", "c"] * 30 + [f"rare {i}" for i in range(50)]
    df = spark.createDataFrame([(i, n, "one", float(i % 2)) for i, n in enumerate(names)], "device_id long, brand string, model string, label double")
    assert features.frequent_levels(df, "brand", 3) == ["back\\slash", "c", "it's"]
    assert features.frequent_levels(df, "model", 3) is None
    prep, ready = fit._prepared(df, fit.EMPTY_INPUTS, True, False)
    slots = {r.brand: r.brand_slot for r in ready.collect()}
    assert all(slots[n] == n for n in names[:3]) and {v for k, v in slots.items() if k.startswith("rare")} <= {f"slot {i}" for i in range(4)}
    assert ready.schema["features"].metadata["ml_attr"]["num_attrs"] <= 3 + 4 + 1 + 2
    unseen = prep.transform(spark.createDataFrame([(1, "new", "one", 0.0), (2, None, None, 0.0)], df.schema)).collect()
    assert len(unseen) == 2


def test_constant_inputs_are_left_out(spark):
    space = FeatureSpace(labels=4)
    rng = random.Random(1)
    data = [(i, [float(rng.randrange(3)), 5.0, 0.0, float(i % 2)], "x", "y", ["F23-", "M22-"][i % 2]) for i in range(40)]
    from pyspark.ml.functions import array_to_vector

    df = spark.createDataFrame(data, "device_id long, a array<double>, brand string, model string, grp string")
    df = df.withColumn("labels", array_to_vector("a").alias("labels", metadata={"ml_attr": {"num_attrs": 4}}))
    model = fit.fit_forest(df, fit.BASE_INPUTS, ["F23-", "M22-"], fit.Forest(3, 3))
    assert fit.fitted_names(model, fit.BASE_INPUTS, space) == ["1", "4", "brand", "model"]
    found = {r.feature: r.importance for r in fit.importances(model, fit.BASE_INPUTS, space, df).collect()}
    assert set(found) == {"1", "2", "3", "4", "brand", "model"} and found["2"] == found["3"] == 0.0
    assert sum(found.values()) == pytest.approx(1)
    kept = Pipeline(stages=fit.feature_stages(fit.BASE_INPUTS, drop_constant=False)).fit(df)
    assert fit.fitted_names(kept, fit.BASE_INPUTS, space) == ["1", "2", "3", "4", "brand", "model"]


def traversal(points, first, k):
    chosen = [first]
    while len(chosen) < k:
        gap = [min((x - a) ** 2 + (y - b) ** 2 for a, b in chosen) for x, y in points]
        best = max(gap)
        if best <= 0:
            break
        chosen.append(min(p for p, g in zip(points, gap) if g == best))
    return chosen


def test_furthest_starts_equal_a_plain_traversal(spark):
    rng = random.Random(7)
    points = sorted({(float(rng.randrange(-30, 30)), float(rng.randrange(-30, 30))) for _ in range(200)})
    df = spark.createDataFrame([(x, y, 1.0) for x, y in points], "longitude double, latitude double, weight double").repartition(6)
    got = location.furthest_starts(df, 12, 3)
    assert got == traversal(points, got[0], 12) and len(set(got)) == 12
    assert len(location.furthest_starts(df.limit(5), 12, 3)) == 5
    assert location.furthest_starts(df.limit(0), 12, 3) == []


def test_furthest_clusters(spark):
    rng = np.random.default_rng(3)
    centres = [(-50.0, 10.0), (0.0, 0.0), (40.0, 30.0), (40.0, -30.0)]
    data = [(i, float(x + rng.normal()), float(y + rng.normal())) for i, (x, y) in enumerate(centres * 50)]
    events = spark.createDataFrame(data, "event_id long, longitude double, latitude double")
    for standardize in (False, True):
        found = location.fit_clusters(events, 4, 1, 1000, standardize, init="furthest")
        assert all(min((x - a) ** 2 + (y - b) ** 2 for a, b in found.centres) < 1 for x, y in centres)
        groups = {}
        for r in location.assign_clusters(events, found).select("event_id", "cluster").collect():
            groups.setdefault(r.cluster, []).append(data[r.event_id])
        for i, own in groups.items():
            assert found.centres[i] == pytest.approx((np.mean([o[1] for o in own]), np.mean([o[2] for o in own])), abs=1e-6)
    with pytest.raises(ValueError, match="init"):
        location.fit_clusters(events, 4, init="other")


def test_scaled_blocks(spark):
    people = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "device_id long, brand string")
    counts = spark.createDataFrame([(1, 1, 6), (1, 3, 2), (2, 2, 4)], "device_id long, k int, n long")
    total = spark.createDataFrame([(1, 8), (3, None)], "device_id long, allev long")
    factors = spark.createDataFrame([("a", 3.0), ("b", 0.0), ("c", 4.0)], "feature string, factor double")
    got = features.attach_scaled_blocks(people, factors, Block(counts, "n", ["a", "b", "c"], "k", 1), Block(total, "allev", ["allev"]))
    assert got.columns == ["device_id", "brand", "a", "b", "c", "allev"]
    assert rows(got) == {(1, "x", 2.0, None, 0.5, 8.0), (2, "y", 0.0, None, 0.0, None), (3, "z", None, None, None, None)}


def plain_rounds(points, centres, most):
    """Centres moved to the weighted means of their points, one point at a time."""
    for _ in range(most):
        sums = {}
        for x, y, w in points:
            gap = [(x - a) ** 2 + (y - b) ** 2 for a, b in centres]
            own = sums.setdefault(gap.index(min(gap)), [0.0, 0.0, 0.0])
            for i, v in enumerate((w, w * x, w * y)):
                own[i] += v
        new = [(sums[i][1] / sums[i][0], sums[i][2] / sums[i][0]) if i in sums else c for i, c in enumerate(centres)]
        shift, centres = max((a - c) ** 2 + (b - d) ** 2 for (a, b), (c, d) in zip(new, centres)), new
        if shift <= 1e-18:
            break
    return centres


def test_rounds_over_tiles_equal_plain_rounds(spark, monkeypatch):
    """Tiles of a few points, points in one place and in a line, several tasks, a start that no point is near."""
    rng = random.Random(11)
    places = {(round(rng.gauss(0, 20), 1), round(rng.gauss(0, 8), 1)) for _ in range(700)} | {(float(i), 0.0) for i in range(90)}
    points = [(x, y, float(rng.randrange(1, 9))) for x, y in sorted(places)]
    df = spark.createDataFrame(points, "longitude double, latitude double, weight double").repartition(5)
    monkeypatch.setattr(location, "TILE", 16)
    monkeypatch.setattr(location, "TASK_TILES", 9)
    starts = [*location.furthest_starts(df, 12, 3), (900.0, 900.0)]
    assert starts[:12] == traversal([p[:2] for p in points], starts[0], 12)
    for most in (1, 3, 1000):
        assert np.allclose(location.settle(df, starts, most), plain_rounds(points, starts, most), atol=1e-9)
    one = spark.createDataFrame([(2.0, 3.0, 4.0)], df.schema)
    assert location.settle(one, [(0.0, 0.0), (5.0, 5.0)], 9) == [(2.0, 3.0), (5.0, 5.0)] and location.settle(one, [], 9) == []
    assert location.settle(df.limit(0), [(1.0, 2.0)], 9) == [(1.0, 2.0)]


def test_a_round_is_one_stage(spark):
    """Hundreds of rounds: each is a job without a shuffle over tiles that were written once."""
    df = spark.createDataFrame([(float(i % 7), float(i % 5), 1.0) for i in range(35)], "longitude double, latitude double, weight double")
    tiles, tasks = location.tiled(df)
    assert tasks == 1 and set(tiles.columns) == {"facts", "points"}
    plan = tiles.coalesce(tasks).mapInArrow(location._tile_sums(np.zeros((2, 2))), "sums binary")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "HashAggregate" not in plan


def test_wide_rows_are_built_a_few_at_a_time(spark, monkeypatch):
    """No aggregate, sort or exchange has a buffer as wide as the vocabulary; repeated and missing entries count as before."""
    people = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (3, "z"), (None, "n")], "device_id long, brand string")
    counts = spark.createDataFrame([(1, 1, 6), (1, 1, 4), (1, 3, 2), (2, None, 4), (None, 2, 9)], "device_id long, k int, n long")
    names = [f"f{i}" for i in range(300)]
    for cells in (1_000_000, 1):
        monkeypatch.setattr(features, "WIDE_CELLS", cells)
        got = features.attach_blocks(people, Block(counts, "n", names, "k", 1))
        assert got.columns == ["device_id", "brand", *names] and dict(got.dtypes)["f0"] == "bigint"
        found = {r.device_id: (r.f0, r.f1, r.f2, r.f299) for r in got.collect()}
        assert got.count() == 4 and found == {1: (10, 0, 2, 0), 2: (0, 0, 0, 0), 3: (None,) * 4, None: (None,) * 4}
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert max((line.count("sum(") for line in plan.splitlines() if "Aggregate" in line), default=0) == 0 and "pivotfirst" not in plan
        wide = features.widen(counts, "k", "n", {i + 1: n for i, n in enumerate(names)})
        assert {r.device_id: (r.f0, r.f1, r.f2) for r in wide.collect()} == {1: (10, 0, 2), 2: (0, 0, 0), None: (0, 9, 0)}
