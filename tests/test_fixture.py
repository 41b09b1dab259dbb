"""The hand-checked fixture, one check per rule."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from devfold.functions import encode_gender, label_map, time_slice, to_int
from devfold.operators import attributes, features, labels, leak, location, population, timeofday
from devfold.schemas import FeatureSpace, table_schema
from tests.conftest import BIG, rows


@pytest.fixture(scope="module")
def label_counts(tables):
    return labels.device_label_counts(
        tables["app_labels"], tables["app_events"], tables["events"]
    )


@pytest.fixture(scope="module")
def slice_counts(tables):
    return timeofday.device_slice_counts(tables["events"])


@pytest.fixture(scope="module")
def base(tables, label_counts):
    attrs = attributes.base_attributes(
        tables["gender_age_train"], tables["phone_brand_device_model"]
    )
    return labels.label_matrix(attrs, label_counts)


def test_ids_survive_csv(tables):
    assert BIG in {r.device_id for r in tables["gender_age_train"].collect()}


def test_slices(tables):
    found = tables["events"].select("event_id", time_slice("ts").alias("s"))
    assert rows(found) == {(1, 1), (2, 1), (3, 2), (4, 144), (5, None)}


def test_slice_width_is_a_parameter(tables):
    found = tables["events"].select("event_id", time_slice("ts", 60).alias("s"))
    assert rows(found) == {(1, 1), (2, 1), (3, 1), (4, 24), (5, None)}


def test_empty_rows_go_but_a_missing_time_stays(spark, tables):
    blank = spark.createDataFrame([(None,) * 5], tables["events"].schema)
    both = tables["events"].unionByName(blank)
    assert timeofday.events_with_slice(both).count() == 5
    assert timeofday.device_slice_counts(both).where("device_id is null").count() == 0


def test_slice_counts(slice_counts):
    assert rows(slice_counts) == {(BIG, 1, 2), (BIG, 2, 1), (2, 144, 1), (2, None, 1)}


def test_time_histogram(slice_counts):
    hist = timeofday.time_histogram(slice_counts)
    assert hist.columns == ["device_id"] + [f"t{i}" for i in range(1, 145)]
    found = {r.device_id: r.asDict() for r in hist.collect()}
    sums = {k: sum(v[f"t{i}"] for i in range(1, 145)) for k, v in found.items()}
    assert sums == {BIG: 3, 2: 1}
    assert (found[2]["t143"], found[2]["t144"]) == (0, 1)


def test_label_counts(label_counts):
    assert rows(label_counts) == {(BIG, 7, 2), (BIG, 1021, 1), (2, 42, 1)}


def test_label_strings_and_back(label_counts):
    strings = labels.device_label_strings(label_counts)
    assert rows(strings) == {(BIG, "7,1021", "2,1"), (2, "42", "1")}
    assert rows(labels.parse_label_list(strings)) == rows(label_counts)


def test_group_concat_of_nothing_is_empty(spark):
    df = spark.createDataFrame([(1, None, None)], "device_id long, label_id int, ile long")
    assert rows(labels.device_label_strings(df)) == {(1, "", "")}
    assert labels.parse_label_list(labels.device_label_strings(df)).count() == 0


def test_first_of_a_repeated_label_wins(spark):
    df = spark.createDataFrame([("7,9,7,x", "1,2,3,4")], "a string, b string")
    assert df.select(label_map("a", "b")).head()[0] == {7: 1, 9: 2}


def test_label_block_missing_or_zero(base):
    found = {r.device_id: r.asDict() for r in base.collect()}
    names = FeatureSpace().label_names
    assert found[2]["42"] == 1 and sum(found[2][n] for n in names) == 1
    assert (found[BIG]["7"], found[BIG]["1021"], found[BIG]["8"]) == (2, 1, 0)
    assert all(found[3][n] is None for n in names)
    assert base.schema.fieldNames() == table_schema("base_profile").fieldNames()


def test_label_outside_the_vocabulary_ends_the_run(tables, label_counts):
    attrs = attributes.base_attributes(
        tables["gender_age_train"], tables["phone_brand_device_model"]
    )
    with pytest.raises(Exception, match="outside the vocabulary of 50"):
        labels.label_matrix(attrs, label_counts, 50).collect()
    with pytest.raises(Exception, match="outside the vocabulary of 1"):
        location.cluster_histogram(label_counts.selectExpr("device_id", "1 as cluster", "ile as n"), 1).collect()
    found = features.outside_vocabulary(label_counts, "label_id", "ile", 1, 50)
    assert rows(found) == {(1, 1, 1)}
    assert rows(features.outside_vocabulary(label_counts, "label_id", "ile", 1, 1021)) == {(0, 0, 0)}


def test_attributes_one_row_per_device(tables):
    found = attributes.device_attributes(
        tables["gender_age_train"], tables["phone_brand_device_model"]
    )
    assert found.count() == 3
    assert rows(found.where("device_id = 2")) == {(2, "M", 30, "A", "a2", "M29-31")}


def test_attributes_come_from_one_row(spark, tables):
    phones = spark.createDataFrame(
        [(3, "A", "z9"), (3, "B", "b1")], tables["phone_brand_device_model"].schema
    )
    found = attributes.device_attributes(tables["gender_age_train"], phones)
    assert rows(found.select("phone_brand", "device_model")) == {("A", "z9")}


def test_gender_and_numbers(spark):
    df = spark.createDataFrame([("F", "12"), ("M", "x"), (None, None)], "g string, t string")
    found = df.select(encode_gender("g").alias("g"), to_int("t").alias("t"))
    assert rows(found) == {(0, 12), (1, None), (None, None)}


def test_event_totals(tables):
    events = tables["events"]
    assert rows(location.events_per_device(events)) == {(BIG, 3), (2, 2)}
    assert rows(location.nolocation_per_device(events)) == {(BIG, 1), (2, 1)}
    assert rows(location.without_location(events).select("event_id")) == {(1,), (4,)}


def test_rollup_agrees_with_direct_counts(tables, slice_counts):
    events, centres = tables["events"], [(0.0, 0.0), (1.0, 2.0), (0.0, 7.0)]
    rollup = location.activity_rollup(events, centres)
    assert rows(location.rollup_slices(rollup)) == rows(slice_counts)
    assigned = location.assign_clusters(events, centres)
    assert rows(location.rollup_clusters(rollup)) == rows(
        location.device_cluster_counts(assigned)
    )
    assert rows(location.rollup_totals(rollup)) == {(BIG, 3, 1), (2, 2, 1)}


def test_populations(tables, base, slice_counts):
    hist = timeofday.time_histogram(slice_counts)
    full = population.full_profile(base, hist)
    empty = population.empty_profile(base, tables["events"])
    assert {r.device_id for r in full.select("device_id").collect()} == {BIG, 2}
    assert rows(empty.select("device_id")) == {(3,)}
    assert empty.columns == table_schema("empty_profile").fieldNames()
    assert rows(population.devices_without_events(base, tables["events"])) == {(3,)}


def test_all_profile_keeps_every_device(tables, base, slice_counts):
    centres = [(0.0, 0.0), (1.0, 2.0), (0.0, 7.0)]
    rollup = location.activity_rollup(tables["events"], centres)
    totals = location.rollup_totals(rollup)
    clusters = location.cluster_histogram(location.rollup_clusters(rollup), 4)
    hist = timeofday.time_histogram(slice_counts)
    found = population.all_profile(base, hist, totals, totals, clusters)
    attrs = attributes.base_attributes(
        tables["gender_age_train"], tables["phone_brand_device_model"]
    )
    counts = labels.device_label_counts(tables["app_labels"], tables["app_events"], tables["events"])
    at_once = features.attach_blocks(
        attrs,
        labels.label_block(counts),
        timeofday.time_block(slice_counts),
        *location.total_blocks(totals),
        location.cluster_block(location.rollup_clusters(rollup), 4),
    )
    assert at_once.columns == found.columns and rows(at_once) == rows(found)
    assert found.columns == table_schema("all_profile", FeatureSpace(clusters=4)).fieldNames()
    by_id = {r.device_id: r.asDict() for r in found.collect()}
    assert set(by_id) == {BIG, 2, 3}
    assert [by_id[BIG][f"c{i}"] for i in range(4)] == [1, 1, 1, 0]
    assert by_id[3]["t1"] is None and by_id[3]["allev"] is None and by_id[3]["c0"] is None


def test_all_devices(tables):
    found = attributes.all_devices(tables["gender_age_train"], tables["gender_age_test"])
    assert found.count() == 4
    assert rows(found.where("device_id = 4")) == {(4, None, None, None)}


def test_first_event(tables):
    assert rows(leak.first_event(tables["events"])) == {(BIG, 1), (2, 4)}


def test_leak_order_keeps_every_phone_row(tables):
    found = leak.leak_table(
        tables["gender_age_train"],
        tables["gender_age_test"],
        tables["phone_brand_device_model"],
        tables["events"],
    )
    assert [r.device_id for r in found.collect()] == [BIG, 4, 2, 2, 3]
    assert rows(found.select("device_id", "event")) == {(BIG, 1), (4, None), (2, 4), (3, None)}


def test_categories(tables):
    found = labels.with_category(tables["app_labels"], tables["label_categories"])
    expected = {(10, 7, "Games"), (11, 7, "Games"), (11, 1021, None), (12, 42, "Finance")}
    assert rows(found.select("app_id", "label_id", "category")) == expected
    counts = labels.label_category_counts(tables["app_labels"], tables["label_categories"])
    assert rows(counts) == {("Games", 1, 2), ("Finance", 1, 1), (None, 1, 1)}


def _long(spark, data):
    return spark.createDataFrame(data, "device_id long, block string, feature string, value double")


def test_scale_factors(spark):
    train = _long(spark, [(1, "labels", "b", 2.0), (1, "labels", "c", 1.0), (1, "labels", "d", 9.0)])
    test = _long(spark, [(2, "labels", "b", 1.0), (2, "labels", "c", 3.0), (2, "labels", "x", 5.0)])
    factors = features.scale_factors(["a", "b", "c", "d"], train, test)
    assert rows(factors) == {("a", 0.0), ("b", 2.0), ("c", 3.0), ("d", 3.0)}
    zero = _long(spark, [(1, "labels", "a", 0.0), (1, "labels", "d", 6.0)])
    scaled = features.apply_scale(zero, factors).select("feature", "value")
    assert rows(scaled) == {("a", None), ("d", 2.0)}
    unknown = features.apply_scale(_long(spark, [(1, "labels", "new", 6.0)]), factors)
    assert rows(unknown.select("feature", "value")) == {("new", 6.0)}


def test_statistics_count_absent_as_zero(spark):
    long = _long(
        spark,
        [(1, "labels", "1", 4.0), (2, "labels", "1", 4.0), (1, "labels", "2", 3.0), (9, "time", "t1", 5.0)],
    )
    assert rows(features.feature_stats(long)) == {
        ("1", 4.0, 4.0, 4.0), ("2", 0.0, 3.0, 1.5), ("t1", 5.0, 5.0, 5.0),
    }
    constants = features.constant_features(long, ["1", "2", "3"])
    assert rows(constants) == {("1", 4.0), ("3", 0.0)}
    kept = features.drop_constant(long, constants).select("device_id", "feature")
    assert rows(kept) == {(1, "2"), (9, "t1")}


def test_long_features(tables, label_counts, slice_counts):
    rollup = location.activity_rollup(tables["events"], [(0.0, 0.0)])
    long = features.long_features(
        label_counts, slice_counts, location.rollup_totals(rollup), location.rollup_clusters(rollup)
    )
    of_two = rows(long.where("device_id = 2").select("block", "feature", "value"))
    assert of_two == {
        ("labels", "42", 1.0), ("time", "t144", 1.0), ("allev", "allev", 2.0),
        ("nolat", "nolat", 1.0), ("clusters", "c0", 2.0),
    }


def test_replace_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    found = features.replace_columns(df, {"a": F.col("b") * 10, "z": "c"})
    assert found.columns == ["a", "b", "z"] and rows(found) == {(20, 2, 3)}


def test_reconcile_and_peek(tables, slice_counts):
    hist = timeofday.time_histogram(slice_counts)
    assert rows(population.reconcile(slice_counts, hist)) == {("in", 4, 2), ("out", 2, 2)}
    found = population.peek(tables["events"], ["event_id"], 2)
    assert [r.event_id for r in found.collect()] == [1, 2]
