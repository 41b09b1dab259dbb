"""Models on separable data: better than the prior, repeatable, and storable."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from devfold.models import fit, scoring, split, stacking
from devfold.models.vectors import block_means, block_vectors, fill_blocks, profile_vectors
from devfold.operators import location
from devfold.schemas import FeatureSpace
from devfold.sources import load_model, save_model
from tests.conftest import rows

CLASSES = ["F23-", "M22-", "M39+"]
SPACE = FeatureSpace(labels=6, slices=4, clusters=3)


@pytest.fixture(scope="module")
def frames(spark):
    """Three classes, each with its own favourite label, slice and cluster."""
    ids = spark.range(300).withColumnRenamed("id", "device_id")
    kind = (F.col("device_id") % 3).cast("int")
    people = ids.select(
        "device_id",
        F.when(kind == 0, 0).otherwise(1).alias("gender"),
        F.when(kind == 0, 20).when(kind == 1, 21).otherwise(45).alias("age"),
        F.when(kind == 2, "X").otherwise("Y").alias("brand"),
        (F.col("device_id") % 5).cast("string").alias("model"),
        F.get(F.lit(CLASSES), kind).alias("grp"),
    )
    noise = F.pmod(F.hash("device_id"), F.lit(3))
    labels = ids.select("device_id", (kind + 1).alias("label_id"), (noise + 2).cast("long").alias("ile"))
    labels = labels.unionByName(
        ids.select("device_id", F.lit(6).alias("label_id"), (noise + 1).cast("long").alias("ile"))
    )
    active = ids.where("device_id % 4 > 0")
    slices = active.select("device_id", (kind + 1).alias("slice"), (noise + 1).cast("long").alias("c"))
    totals = active.select("device_id", (noise + 1).cast("long").alias("allev"), F.lit(None).cast("long").alias("nolat"))
    totals = totals.withColumn("nolat", F.when(F.col("device_id") % 2 == 0, 1).cast("long"))
    clusters = active.select("device_id", kind.alias("cluster"), (noise + 1).cast("long").alias("n"))
    vectors = profile_vectors(people, labels, slices, totals, clusters, SPACE).cache()
    means = block_means(vectors)
    return vectors, fill_blocks(vectors, means), means


def _logloss(model, df, classes=CLASSES):
    return scoring.evaluate(scoring.submission(model, df, classes, ["grp"]), "grp", classes).head()


def test_missing_block_is_null_then_mean(frames):
    vectors, filled, means = frames
    assert vectors.where("time is null").count() == 75
    got = filled.where("device_id = 4").select("time").head()[0]
    assert got.toArray().tolist() == pytest.approx(means["time"])
    assert sum(means["time"]) > 0
    assert filled.where("time is null or clusters is null").count() == 0


def test_block_vector_refuses_keys_outside_the_vocabulary(spark):
    counts = spark.createDataFrame([(1, 2, 5), (1, 0, 3), (2, None, 1)], "device_id long, k int, n long")
    found = {r.device_id: r.v for r in block_vectors(counts, F.col("k"), "n", 3, "v").collect()}
    assert found[1].toArray().tolist() == [3.0, 0.0, 5.0]
    assert found[2].toArray().tolist() == [0.0, 0.0, 0.0]
    with pytest.raises(Exception, match="outside the vocabulary of 2: 2"):
        block_vectors(counts, F.col("k"), "n", 2, "v").collect()


def test_naive_bayes_learns_the_class_moments(spark, frames):
    _, filled, _ = frames
    inputs = fit.Inputs(("labels",), (), ())
    model = fit.fit_naive_bayes(filled, inputs, CLASSES)
    names = fit.fitted_names(model, inputs, SPACE)
    assert names == ["1", "2", "3", "6"]  # labels 4 and 5 never occur
    long = spark.createDataFrame(
        [
            (r.device_id, str(i + 1), float(v))
            for r in filled.select("device_id", "labels").collect()
            for i, v in enumerate(r.labels.toArray())
            if v
        ],
        "device_id long, feature string, value double",
    ).withColumn("block", F.lit("labels"))
    stats = scoring.class_stats(long, filled.select("device_id", "grp"), SPACE.label_names)
    assert stats.count() == len({r.grp for r in stats.collect()}) * SPACE.labels
    theta, sigma = model.stages[-1].theta.toArray(), model.stages[-1].sigma.toArray()
    for r in stats.collect():
        if r.feature not in names:
            assert (r["mean"], r.variance) == (0.0, 0.0)
            continue
        row, col = CLASSES.index(r.grp), names.index(r.feature)
        assert theta[row, col] == pytest.approx(r["mean"])
        assert sigma[row, col] == pytest.approx(r.variance, abs=1e-6)
    assert _logloss(model, filled).logloss < 0.1


def test_forest_beats_the_prior_and_ranks_features(frames):
    _, filled, _ = frames
    size = fit.Forest(10, 5)
    model = fit.fit_forest(filled, fit.ALL_INPUTS, CLASSES, size, seed=3)
    prior = scoring.prior_submission(filled, filled, "model", CLASSES, ["grp"])
    before = scoring.evaluate(prior, "grp", CLASSES).head()
    after = _logloss(model, filled)
    assert after.logloss < before.logloss / 2 and after.r2 > before.r2
    ranked = fit.importances(model, fit.ALL_INPUTS, SPACE, filled).collect()
    assert {r.feature for r in ranked[:3]} <= {"1", "2", "3", "t1", "t2", "t3", "brand"}
    assert sum(r.importance for r in ranked) == pytest.approx(1.0)


def test_network_scores_sum_to_one_and_survive_storage(tmp_path, frames):
    _, filled, _ = frames
    model = fit.fit_mlp(filled, fit.ALL_INPUTS, CLASSES, fit.Network((8,), 60), seed=3)
    scored = scoring.submission(model, filled, CLASSES)
    assert scored.columns == ["device_id", *CLASSES]
    total = scored.select(sum((F.col(f"`{c}`") for c in CLASSES), F.lit(0.0)).alias("t"))
    assert total.where("abs(t - 1) > 1e-9").count() == 0
    path = save_model(model, str(tmp_path / "net-"), stamp=True)
    assert path != str(tmp_path / "net-")
    assert rows(scoring.submission(load_model(path), filled, CLASSES)) == rows(scored)
    assert _logloss(model, filled).logloss < 0.3
    ranked = fit.network_importances(model, fit.ALL_INPUTS, SPACE, filled).collect()
    names = fit.input_names(fit.ALL_INPUTS, SPACE)
    assert sorted(r.feature for r in ranked) == sorted(names) and ranked[0].importance == 1.0
    assert {r.feature for r in ranked[:5]} & {"1", "2", "3"}


def test_unseen_levels_and_absent_classes_still_score(spark, frames):
    _, filled, _ = frames
    classes = [*CLASSES, "Z99"]
    model = fit.fit_forest(filled, fit.EMPTY_INPUTS, classes, fit.Forest(3, 3), seed=1)
    strange = filled.withColumn("brand", F.lit("never seen")).withColumn("model", F.lit(None).cast("string"))
    scored = scoring.submission(model, strange, classes)
    assert scored.count() == 300 and scored.where("Z99 > 0").count() == 0


def test_stacked_model(tmp_path, frames):
    _, filled, _ = frames
    model = stacking.fit_stacked(
        filled, CLASSES, folds=2, seed=1, size=fit.Network((8,), 60),
        age_fit=lambda df: fit.fit_age(df, trees=10, depth=3),
        gender_fit=lambda df: fit.fit_gender(df, size=fit.Network((8,), 40)),
    )
    hidden = filled.withColumn("age", F.lit(None).cast("int")).withColumn("gender", F.lit(None).cast("int"))
    assert _logloss(model, hidden).logloss < 0.4
    model.save(str(tmp_path / "stacked"))
    again = stacking.StackedModel.load(str(tmp_path / "stacked"))
    assert rows(scoring.submission(again, hidden, CLASSES)) == rows(
        scoring.submission(model, hidden, CLASSES)
    )


def test_first_stage_scores_rows_it_never_saw(frames):
    """With targets that only memorising could predict, out-of-fold ages stay near the mean."""
    _, filled, _ = frames
    seen = []

    def age_fit(df):
        seen.append({r.device_id for r in df.select("device_id").collect()})
        return fit.fit_age(df, trees=2, depth=2)

    stacking.fit_stacked(
        filled, CLASSES, folds=3, seed=1, size=fit.Network((4,), 2), age_fit=age_fit,
        gender_fit=lambda df: fit.fit_gender(df, size=fit.Network((4,), 2)),
    )
    everyone = set(range(300))
    assert len(seen) == 4 and seen[-1] == everyone
    held = [everyone - s for s in seen[:3]]
    assert set.union(*held) == everyone and sum(map(len, held)) == 300


def test_grid_search_orders_by_logloss(frames):
    _, filled, _ = frames
    found = fit.grid_search(filled, fit.BASE_INPUTS, CLASSES, trees=(2, 5), depths=(1, 30)).collect()
    assert len(found) == 4 and {r.depth for r in found} == {1, fit.MAX_DEPTH}
    assert [r.logloss for r in found] == sorted(r.logloss for r in found)


def test_splits(spark):
    df = spark.range(5000).withColumnRenamed("id", "device_id")
    train, valid = split.hash_split(df, 0.9, seed=5)
    again, _ = split.hash_split(df.repartition(17), 0.9, seed=5)
    assert rows(train) == rows(again)
    assert train.count() + valid.count() == 5000 and 4300 < train.count() < 4700
    other, _ = split.hash_split(df, 0.9, seed=6)
    assert rows(other) != rows(train)
    fine, _ = split.hash_split(df, 0.99, seed=5)
    assert rows(train) <= rows(fine)


def test_clusters(spark):
    spots = [(0.0, 0.0), (50.0, 0.0), (0.0, 50.0)]
    points = spark.range(900).select(
        F.col("id").alias("event_id"),
        (F.get(F.lit([s[0] for s in spots]), (F.col("id") % 3).cast("int")) + F.rand(1)).alias("longitude"),
        (F.get(F.lit([s[1] for s in spots]), (F.col("id") % 3).cast("int")) + F.rand(2)).alias("latitude"),
    )
    found = location.fit_clusters(points, 3, seed=1)
    assert {(round(x / 50) * 50, round(y / 50) * 50) for x, y in found.centres} == {
        (0, 0), (50, 0), (0, 50),
    }
    sizes = location.assign_clusters(points, found).groupBy("cluster").count()
    assert {r["count"] for r in sizes.collect()} == {300}


def test_constant_coordinate_takes_no_part(spark):
    line = spark.range(100).select(F.lit(3.0).alias("longitude"), (F.col("id") % 2 * 9.0).alias("latitude"))
    found = location.fit_clusters(line, 2, seed=1)
    assert [x for x, _ in found.centres] == [3.0, 3.0]
    assert sorted(y for _, y in found.centres) == pytest.approx([0.0, 9.0])
    dot = line.withColumn("latitude", F.lit(1.0))
    assert location.fit_clusters(dot, 5).centres == [(3.0, 1.0)]


def test_many_centres_agree_with_brute_force(spark):
    centres = [(float(x), float(y)) for x in range(12) for y in range(12)]
    df = spark.range(500).select(
        F.pmod(F.hash("id"), F.lit(23)).cast("double").alias("longitude"),
        (F.pmod(F.hash(-F.col("id")), F.lit(240)) / 20).alias("latitude"),
    )
    for r in location.assign_clusters(df, centres).collect():
        far = [(r.longitude - x) ** 2 + (r.latitude - y) ** 2 for x, y in centres]
        assert r.cluster == far.index(min(far))


def test_assignment_ties_and_gaps(spark):
    df = spark.createDataFrame([(1.0, 0.0), (9.0, 0.0), (None, 1.0)], "longitude double, latitude double")
    found = location.assign_clusters(df, [(0.0, 0.0), (2.0, 0.0)]).collect()
    assert [r.cluster for r in found] == [0, 1, None]


def test_naive_bayes_of_absent_classes(spark, frames, tmp_path):
    """Classes without a training row get a column of zeros, and the others keep their places."""
    _, filled, _ = frames
    many = ["A", CLASSES[0], "B", CLASSES[2], CLASSES[1]]
    few = scoring.submission(fit.fit_naive_bayes(filled, fit.BASE_INPUTS, CLASSES), filled, CLASSES)
    model = load_model(save_model(fit.fit_naive_bayes(filled, fit.BASE_INPUTS, many), str(tmp_path / "nb")))
    got = scoring.submission(model, filled, many)
    assert got.where("A <> 0 or B <> 0").count() == 0
    one, two = ({r.device_id: [round(r[c], 9) for c in CLASSES] for r in df.collect()} for df in (few, got))
    assert one == two
    best = model.transform(filled).where(F.get(F.lit(many), F.col("prediction").cast("int")) != F.col("grp"))
    assert best.count() < 30


def test_registered_perceptron_has_all_its_layers(monkeypatch):
    from types import SimpleNamespace

    from devfold.registry import queries

    seen = []
    monkeypatch.setattr(queries, "profiles", lambda r: SimpleNamespace(model_frames=lambda: ("train", "test")))
    monkeypatch.setattr(queries.fit, "fit_mlp", lambda train, inputs, classes, size, seed: seen.append((train, inputs, size)) or "model")
    monkeypatch.setattr(queries.scoring, "submission", lambda model, test, classes: (model, test))
    assert queries.mlp_scores(None) == ("model", "test")
    assert seen == [("train", fit.ALL_INPUTS, fit.NETWORKS["all"])]
    assert (fit.NETWORKS["all"].hidden, fit.NETWORKS["all"].epochs) == ((64,) * 6, 500)
