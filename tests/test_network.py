"""Networks with dropout: gradients, independence of the layout, stopping, storage, the age head."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from devfold.models import fit, network, scoring, stacking
from devfold.models.network import NetworkModel, Shape, Training
from devfold.sources import load_model, save_model
from tests.test_models import CLASSES, SPACE, _logloss, frames  # noqa: F401

QUICK = Training(60, rate=0.02, patience=15)


@pytest.mark.parametrize("head", ["classes", "number"])
@pytest.mark.parametrize("activation", ["tanh", "rectifier"])
@pytest.mark.parametrize("share", [0.0, 0.4])
def test_gradient_equals_differences(head, activation, share):
    rng = np.random.default_rng(3)
    shape = Shape((5, 7, 6, 3 if head == "classes" else 1), head, activation)
    flat = shape.start(1) + rng.normal(0, 0.1, shape.size)
    x = rng.normal(size=(11, 5))
    y = rng.integers(0, 3, 11).astype(float) if head == "classes" else rng.normal(size=11)
    masks = network.dropout(shape, rng.integers(0, 2**62, 11), 4, 9, share, share)
    slope, loss = network.gradient(shape, flat, x, y, masks)
    assert loss == pytest.approx(network.loss_of(shape, network.outputs(shape, flat, x, masks)[-1], y))
    for i in rng.choice(shape.size, 60, replace=False):
        step = np.zeros(shape.size)
        step[i] = 1e-6
        up, down = (network.loss_of(shape, network.outputs(shape, flat + s, x, masks)[-1], y) for s in (step, -step))
        assert slope[i] == pytest.approx((up - down) / 2e-6, rel=1e-4, abs=1e-6)


def test_dropout_keeps_the_expected_sum_and_depends_on_the_row_alone():
    shape, keys = Shape((40, 30, 20, 2)), np.arange(4000, dtype=np.int64) * 977
    masks = network.dropout(shape, keys, 3, 5, 0.1, 0.25)
    assert [set(np.round(np.unique(m), 9)) for m in masks] == [{0.0, round(1 / 0.9, 9)}] + [{0.0, round(1 / 0.75, 9)}] * 2
    assert all(abs(m.mean() - 1) < 0.02 for m in masks)
    again = network.dropout(shape, keys[::-1].copy(), 3, 5, 0.1, 0.25)
    assert all((a == b[::-1]).all() for a, b in zip(masks, again))
    assert not (network.dropout(shape, keys, 4, 5, 0.1, 0.25)[1] == masks[1]).all()
    assert network.dropout(shape, keys, 3, 5, 0.0, 0.0) == [None, None, None]


def test_dense_reads_both_kinds_of_vectors(spark):
    rows = spark.sql("select array(1D, 0D, 2D) a union all select array(0D, 3D, 0D)")
    full = rows.select(F.unwrap_udt(array_to_vector("a")).alias("v")).toArrow()["v"].combine_chunks()
    full = full.chunk(0) if isinstance(full, pa.ChunkedArray) else full
    sparse = pa.StructArray.from_arrays(
        [pa.array([0, 0], pa.int8()), pa.array([3, 3], pa.int32()), pa.array([[0, 2], [1]], pa.list_(pa.int32())), pa.array([[1.0, 2.0], [3.0]])],
        names=["type", "size", "indices", "values"],
    )
    wanted = [[1.0, 0.0, 2.0], [0.0, 3.0, 0.0]]
    assert sorted(network.dense(full, 3).tolist()) == sorted(wanted)
    assert network.dense(sparse, 3).tolist() == wanted
    assert network.dense(sparse.slice(1), 3).tolist() == wanted[1:]


def _table(spark, n=400, parts=4):
    """Two classes by the sign of a product, with one input that never varies."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(a), float(b), 7.0], float(a * b > 0)) for i, (a, b) in enumerate(rng.normal(size=(n, 2)))]
    df = spark.createDataFrame(rows, "device_id long, a array<double>, label double")
    return df.select("device_id", array_to_vector("a").alias("features"), "label").repartition(parts)


def test_the_layout_changes_nothing(spark, monkeypatch):
    how = Training(6, steps=2, hidden_dropout=0.2, input_dropout=0.1, l1=1e-4, l2=1e-3, most_squared=5.0)
    one = network.train(_table(spark, parts=1), "label", "device_id", (6, 5), 2, how=how, seed=3)
    monkeypatch.setattr(network, "TASK_ROWS", 7)
    monkeypatch.setattr(network, "DENSE_ROWS", 5)
    monkeypatch.setattr(network, "FAN", 3)
    two = network.train(_table(spark, parts=9), "label", "device_id", (6, 5), 2, how=how, seed=3)
    assert np.allclose(one.weights, two.weights, atol=1e-9)
    assert len(one.curve) == 7 and np.allclose([c[2] for c in one.curve], [c[2] for c in two.curve])


def test_learns_what_no_line_separates(spark):
    df = _table(spark)
    found = network.train(df, "label", "device_id", (12, 12), 2, how=Training(150, rate=0.02, patience=None), seed=1)
    scored = NetworkModel.of(found).transform(df)
    assert scored.where("prediction = label").count() > 380
    sums = scored.select(vector_to_array("probability").alias("p")).selectExpr("p[0] + p[1] as s").agg(F.min("s"), F.max("s")).head()
    assert sums[0] == pytest.approx(1) and sums[1] == pytest.approx(1)


def test_momentum_and_bounded_weights(spark):
    how = Training(40, adaptive=False, rate=0.5, momentum_start=0.2, momentum_stable=0.9, momentum_ramp=4000, annealing=1e-6, most_squared=2.0, patience=None)
    found = network.train(_table(spark), "label", "device_id", (12,), 2, how=how, seed=1)
    assert found.curve[-1][1] < found.curve[0][1]
    for weights, _ in found.shape.split(found.weights):
        assert ((weights**2).sum(axis=0) <= 2.0 + 1e-9).all()


def test_stopping_returns_the_best_epoch(spark):
    """Labels are noise, so further epochs only hurt the held-out rows."""
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=12).tolist(), float(rng.integers(0, 2))) for i in range(200)]
    df = spark.createDataFrame(rows, "device_id long, a array<double>, label double").select("device_id", array_to_vector("a").alias("features"), "label")
    long = Training(60, rate=0.02, patience=None, holdout=0.3)
    held = df.where(network.hash_bucket("device_id", network.BUCKETS, 2) < 3000)
    known = df.where(network.hash_bucket("device_id", network.BUCKETS, 2) >= 3000)
    all_epochs = network.train(known, "label", "device_id", (30,), 2, how=long, seed=2, valid=held)
    stopped = network.train(df, "label", "device_id", (30,), 2, how=Training(60, rate=0.02, patience=5, holdout=0.3), seed=2)
    losses = [c[2] for c in all_epochs.curve]
    assert losses[-1] > min(losses) + 0.05 and len(losses) == 61
    assert len(stopped.curve) < 61 and np.allclose([c[2] for c in stopped.curve], losses[: len(stopped.curve)])
    best = min(range(len(stopped.curve)), key=lambda i: stopped.curve[i][2])
    assert len(stopped.curve) == best + 6
    table = stopped.table(spark)
    assert table.columns == ["epoch", "train_loss", "valid_loss"] and table.count() == len(stopped.curve)
    again = network.train(held.limit(0).unionByName(known), "label", "device_id", (30,), 2, how=Training(0), seed=2, valid=held, start=stopped.weights)
    assert again.curve[0][2] == pytest.approx(stopped.curve[best][2])


def test_refusals(spark):
    with pytest.raises(ValueError, match="activation"):
        Training(activation="step")
    with pytest.raises(ValueError, match="dropout"):
        Training(hidden_dropout=1.0)
    with pytest.raises(ValueError, match="no labelled row"):
        network.train(_table(spark).withColumn("label", F.lit(None).cast("double")), "label", "device_id", (3,), 2)
    with pytest.raises(ValueError, match="head"):
        network.train(_table(spark), "label", "device_id", (3,), 2, head="tail")


def test_missing_keys_and_labels(spark):
    df = _table(spark, 60).withColumn("device_id", F.when(F.col("device_id") > 20, F.col("device_id")))
    df = df.withColumn("label", F.when(F.coalesce("device_id", F.lit(0)) % 7 != 1, F.col("label")))
    found = network.train(df, "label", "device_id", (3,), 2, how=Training(2, steps=2, patience=None))
    assert len(found.curve) == 3 and np.isfinite(found.weights).all()


def test_group_network_beats_the_prior_and_survives_storage(spark, frames, tmp_path):  # noqa: F811
    vectors, filled, _ = frames
    model = fit.fit_network(filled, fit.ALL_INPUTS, CLASSES, fit.Network((16, 8), 60), 3, how=QUICK)
    prior = scoring.evaluate(scoring.prior_submission(vectors, vectors, "brand", CLASSES, ["grp"]), "grp", CLASSES).head().logloss
    assert _logloss(model, filled).logloss < 0.5 * prior
    path = save_model(model, str(tmp_path / "net"))
    one, two = (scoring.submission(m, filled, CLASSES).orderBy("device_id").collect() for m in (model, load_model(path)))
    assert one == two and isinstance(load_model(path), PipelineModel)
    curve = fit.loss_curve(model, filled)
    assert curve.where("valid_loss is null").count() == 0 and curve.count() <= 61
    named = fit.network_importances(model, fit.ALL_INPUTS, SPACE, filled).collect()
    assert {r.feature for r in named} == set(fit.input_names(fit.ALL_INPUTS, SPACE))
    assert max(r.importance for r in named) == pytest.approx(1)


def test_age_network(spark, frames):  # noqa: F811
    _, filled, _ = frames
    model = fit.fit_age_network(filled, fit.PERSON_INPUTS, fit.Network((16,), 80), 3, Training(80, rate=0.03, patience=None))
    cast = filled.withColumns({c: F.col(c).cast("double") for c in fit.PERSON_INPUTS.numbers})
    error = model.transform(cast).agg(F.avg(F.abs(F.col("age_prediction") - F.col("age")))).scalar()
    spread = cast.agg(F.avg(F.abs(F.col("age") - 28))).scalar()
    got = cast.select(error.alias("e") if hasattr(error, "alias") else F.lit(error), spread.alias("s") if hasattr(spread, "alias") else F.lit(spread)).head()
    assert got[0] < 0.4 * got[1]
    with pytest.raises(ValueError, match="age"):
        fit.fit_age_network(filled.withColumn("age", F.lit(None).cast("int")))


def test_stacked_networks(spark, frames):  # noqa: F811
    _, filled, _ = frames
    small = fit.Network((8,), 20)
    model = stacking.fit_stacked(
        filled, CLASSES, 2, 3, fit.Network((8,), 30),
        age_fit=lambda df: fit.fit_age_network(df, size=small, how=QUICK),
        gender_fit=lambda df: fit.fit_gender_network(df, size=small, how=QUICK),
    )
    scores = scoring.submission(model, filled, CLASSES)
    assert scores.count() == 300 and scores.columns == ["device_id", *CLASSES]


def test_perceptron_stops_on_held_out_loss(spark, frames):  # noqa: F811
    _, filled, _ = frames
    rough = filled.withColumn("grp", F.get(F.lit(CLASSES), F.pmod(F.xxhash64("device_id"), F.lit(3)).cast("int")))
    stop = fit.Stopping(every=3, patience=2, holdout=0.3)
    model = fit.fit_mlp(rough, fit.ALL_INPUTS, CLASSES, fit.Network((20,), 90), 1, stopping=stop)
    losses = [c[2] for c in model.stages[-1].curve]
    assert len(losses) < 30 and losses[-1] >= min(losses) and losses.index(min(losses)) == len(losses) - 3
    assert scoring.submission(model, filled, CLASSES).count() == 300


def test_halving_keeps_the_better_settings(spark, frames):  # noqa: F811
    _, filled, _ = frames
    slow, good = Training(rate=1e-6), Training(rate=0.03)
    settings = [(fit.Network((4,), 40), slow), (fit.Network((12,), 40), good), (fit.Network((3,), 40), slow), (fit.Network((6,), 40), slow)]
    model, table = fit.halving_search(filled, settings, fit.ALL_INPUTS, CLASSES, 3, first=5)
    found = table.collect()
    assert [r.setting for r in found if r.round == 0] == [0, 1, 2, 3] and 1 in {r.setting for r in found if r.round == 1}
    assert len([r for r in found if r.round == 1]) == 2 and {r.setting for r in found if r.round == 2} == {1}
    assert model.stages[-1].getLayers()[1:] == [12, 3]
    assert _logloss(model, filled).logloss < 0.5
    with pytest.raises(ValueError, match="no setting"):
        fit.halving_search(filled, [])


def test_blocks_are_the_rows(spark, monkeypatch):
    """Blocks hold every row once; products with them equal those of the dense standardised rows."""
    monkeypatch.setattr(network, "DENSE_ROWS", 7)
    rng = np.random.default_rng(2)
    fill, rows = rng.normal(size=30), []
    for i in range(100):
        x = np.where(rng.random(30) < 0.1, rng.normal(size=30), fill if i % 3 else 0.0)
        rows.append((i, float(i % 2), i % 5 - 1, x.tolist()))
    df = spark.createDataFrame(rows, "key long, y double, step int, a array<double>").select("key", "y", "step", array_to_vector("a").alias("features"))
    usual = network.usual_vector(df)
    assert (usual == fill).mean() > 0.9
    table = df.select("key", "y", "step", F.unwrap_udt("features")).mapInArrow(network.blocks(usual), network.BLOCK).toArrow()
    centre, scale, weights, seen = rng.normal(size=30), 1 + rng.random(30), rng.normal(size=(30, 4)), []
    for batch in table.to_batches():
        for i in range(batch.num_rows):
            held, keys, y, x = network.unpacked(batch, i, usual, centre, scale)
            seen += keys.tolist()
            assert held == (rows[keys[0]][2] < 0) and {rows[k][2] for k in keys} == {rows[keys[0]][2]} and y.tolist() == [k % 2 for k in keys]
            plain = (np.array([rows[k][3] for k in keys]) - centre) / scale
            error = rng.normal(size=(len(keys), 4))
            assert np.allclose(x @ weights, plain @ weights) and np.allclose(x.T @ error, plain.T @ error)
            assert np.allclose(x * np.full(30, 2.0), 2 * plain)
    assert sorted(seen) == list(range(100))


def test_filled_rows_are_stored_as_few_differences(spark):
    """Rows filled with the same thousand means: a block multiplies the columns that differ, not all."""
    fill = np.linspace(1, 2, 1000)
    rows = [(i, 1.0, 0, [float(i), *fill.tolist()]) for i in range(50)]
    df = spark.createDataFrame(rows, "key long, y double, step int, a array<double>").select("key", "y", "step", array_to_vector("a").alias("features"))
    table = df.select("key", "y", "step", F.unwrap_udt("features")).mapInArrow(network.blocks(network.usual_vector(df)), network.BLOCK).toArrow()
    assert sum(len(x) for x in table["at"].to_pylist()) // 4 <= table.num_rows
