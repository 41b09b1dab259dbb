"""The batch stages end to end on CSV files."""

from __future__ import annotations

from dataclasses import replace

import pytest

from devfold.models import fit
from devfold.plans.stages import STAGES, Run
from devfold.schemas import FeatureSpace, table_schema
from devfold.session import shared_dir
from devfold.sources import read_inferred, read_table, write_csv
from tests.conftest import BIG, ROWS, rows

SPACE = FeatureSpace(labels=1021, clusters=3)


@pytest.fixture(scope="module")
def run(spark, csv_dir, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    return Run(spark, csv_dir, str(out), SPACE)


def test_feature_stages(spark, run):
    for name in ("time_events", "cluster_events", "munge", "merge", "merge_all", "normalization", "leak"):
        STAGES[name](run)
    out = run.outputs
    hist = read_table(spark, f"{out}/timeevents", "time_histogram")
    assert {r.device_id: r.t1 for r in hist.collect()} == {BIG: 2, 2: 0}
    base = read_table(spark, f"{out}/dev_app_train", "base_profile")
    assert {(r.device_id, r["7"], r["42"]) for r in base.collect()} == {(BIG, 2, 0), (2, 0, 1), (3, None, None)}
    test = read_table(spark, f"{out}/dev_app_test", "base_profile").collect()
    assert [(r.device_id, r.gender, r.brand, r["7"]) for r in test] == [(4, None, "A", None)]
    full = read_table(spark, f"{out}/full_train", "full_profile")
    empty = read_table(spark, f"{out}/empty_train", "empty_profile")
    assert rows(full.select("device_id")) == {(BIG,), (2,)} and rows(empty.select("device_id")) == {(3,)}
    wide = read_inferred(spark, f"{out}/all_train")
    assert wide.columns == table_schema("all_profile", SPACE).fieldNames()
    found = {r.device_id: r for r in wide.collect()}
    assert (found[BIG]["7"], found[BIG]["1021"], found[2]["42"]) == (1.0, 1.0, 1.0)
    assert found[BIG]["1"] is None and found[3]["7"] is None
    order = [r.device_id for r in read_inferred(spark, f"{out}/leak").collect()]
    assert sorted(order) == sorted([BIG, 4, 2, 2, 3])
    constants = read_inferred(spark, f"{out}/constant_labels")
    assert constants.count() == 1018


@pytest.fixture(scope="module")
def populated(spark, run, tmp_path_factory):
    """The fixture with a test device that has activity (5) beside the one without (4), repeated under many ids."""
    folder = tmp_path_factory.mktemp("many")
    more = {
        "gender_age_test": ["5L as device_id"],
        "phone_brand_device_model": ["5L as device_id", "'B' as phone_brand", "'b1' as device_model"],
        "events": ["6L as event_id", "5L as device_id", "timestamp_ntz'2016-05-01 10:00:00' as ts", "1.5D as longitude", "2.5D as latitude"],
    }
    for name in ROWS:
        df = read_table(spark, f"{run.inputs}/{name}.csv", name)
        if name in more:
            df = df.unionByName(spark.range(1).selectExpr(*more[name]))
        if "device_id" in df.columns or "event_id" in df.columns:
            shift = [f"{c} + n * 1000 as {c}" if c in ("device_id", "event_id") else c for c in df.columns]
            df = df.crossJoin(spark.range(25).withColumnRenamed("id", "n")).selectExpr(*shift)
        write_csv(df, str(folder / f"{name}.csv"))
    return Run(
        spark,
        str(folder),
        str(tmp_path_factory.mktemp("modelled")),
        FeatureSpace(labels=1021, clusters=2),
        forests={"empty": fit.Forest(3, 3)},
        networks={k: fit.Network((4,), 5) for k in fit.NETWORKS},
        folds=2,
    )


def test_model_stages(spark, populated):
    for name in ("time_events", "cluster_events", "munge"):
        STAGES[name](populated)
    scored = {"full": {5}, "empty": {4}, "all": {4, 5}, "stacked": {4, 5}, "bayes": {4, 5}}
    for name, devices in scored.items():
        STAGES[f"model_{name}"](populated)
        found = spark.read.csv(f"{populated.outputs}/submit_{name}", header=True, inferSchema=True)
        assert found.columns == ["device_id", *populated.classes]
        ids = [r.device_id for r in found.select("device_id").collect()]
        assert len(ids) == 25 * len(devices) and {i % 1000 for i in ids} == devices
        assert spark.read.csv(f"{populated.outputs}/quality_{name}", header=True).count() == 1
    assert spark.read.csv(f"{populated.outputs}/losses_all", header=True).count() == 6


def test_trees_stay_an_option_for_the_age(spark, populated):
    run = replace(populated, age_trees=2)
    STAGES["model_stacked"](run)
    assert spark.read.csv(f"{run.outputs}/submit_stacked", header=True).count() == 50


def test_csv_is_written_with_a_header(spark, tmp_path, tables):
    write_csv(tables["events"], str(tmp_path / "e"))
    again = read_table(spark, str(tmp_path / "e"), "events")
    assert rows(again) == rows(tables["events"])


def test_schemas():
    assert len(table_schema("time_histogram").fields) == 145
    assert len(table_schema("all_profile").fields) == 6 + 1021 + 144 + 2 + 1000
    with pytest.raises(KeyError):
        table_schema("nothing")


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
