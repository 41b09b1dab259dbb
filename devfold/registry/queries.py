"""One callable per registered query, each over the whole tables in a folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devfold.functions import encode_gender, time_slice, to_int
from devfold.models import fit, scoring, split, stacking
from devfold.operators import (
    attributes,
    features,
    labels,
    leak,
    location,
    population,
    timeofday,
)
from devfold.plans.profiles import Profiles, Sources
from devfold.schemas import FeatureSpace
from devfold.session import materialize, scratch_path
from devfold.sources import load_model, read_inferred, read_table, save_model, write_csv
from devfold.sources.roles import Roles

# Parameters of the registered runs: the whole feature space, and the five groups of
# the generic tables. The grid stands in for fitted centres where SQL must agree.
SPACE = FeatureSpace()
VOCABULARY = SPACE.label_names
GROUPS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
GRID = [(2.5 * i - 48.75, 4.0 * j + 2.0) for i in range(40) for j in range(25)]
DIGITS = 6

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable:
    def register(run: Callable[[Roles], DataFrame]) -> Callable[[Roles], DataFrame]:
        QUERIES[name] = lambda spark, folder: run(Roles(spark, folder))
        return run

    return register


def profiles(r: Roles) -> Profiles:
    sources = Sources(
        train=r.train(),
        test=r.test(),
        phones=r.phones(),
        events=r.events(),
        app_events=r.app_events(),
        app_owners=r.app_owners(),
        app_labels=r.app_labels(),
    )
    return Profiles(sources, SPACE, GRID)


def rounded(df: DataFrame, *columns: str, digits: int = DIGITS) -> DataFrame:
    return df.selectExpr(
        *[f"round(`{c}`, {digits}) as `{c}`" if c in columns else f"`{c}`" for c in df.columns]
    )


# -- scalars and filters -------------------------------------------------------


@query("time_slice")
def time_slice_of_event(r: Roles) -> DataFrame:
    return r.events().select("event_id", time_slice("ts").alias("slice"))


@query("events_with_slice")
def events_with_slice(r: Roles) -> DataFrame:
    return timeofday.events_with_slice(r.events())


@query("drop_empty_rows")
def drop_empty_rows(r: Roles) -> DataFrame:
    key = F.col("event_id") % 7
    fields = ["event_id", "device_id", "longitude", "latitude"]
    holes = r.events().select(
        F.when(key != 0, F.col("event_id")).alias("event_id"),
        *[F.when(key > 1, F.col(c)).alias(c) for c in fields[1:]],
    )
    return timeofday.drop_empty_rows(holes)


@query("encode_gender")
def gender_codes(r: Roles) -> DataFrame:
    return r.devices().select("device_id", encode_gender("gender").alias("gender_code"))


@query("to_int")
def text_numbers(r: Roles) -> DataFrame:
    text = F.when(F.col("p_partkey") % 7 == 0, F.col("p_type")).otherwise(
        F.col("p_size").cast("string")
    )
    parts = r.table("part").select(F.col("p_partkey").alias("app_id"), text.alias("label_text"))
    return parts.withColumn("label_id", to_int("label_text"))


@query("events_without_location")
def events_without_location(r: Roles) -> DataFrame:
    return location.without_location(r.events()).select("event_id", "device_id")


@query("replace_columns")
def replace_columns(r: Roles) -> DataFrame:
    base = attributes.device_attributes(r.train(), r.phones())
    return features.replace_columns(
        base, {"age": (F.col("age") * 12).cast("int"), "brand": "phone_brand"}
    )


@query("index_categories")
def index_categories(r: Roles) -> DataFrame:
    columns = ["phone_brand", "device_model", "grp"]
    base = attributes.device_attributes(r.train(), r.phones())
    coded = features.index_categories(base, columns)
    return coded.select("device_id", *columns, *[f"{c}_idx" for c in columns])


@query("level_codes")
def level_codes(r: Roles) -> DataFrame:
    """Codes of a column in which every row is a level of its own."""
    return features.level_codes(r.devices(), "device_id")


# -- time of day ---------------------------------------------------------------


@query("device_slice_counts")
def device_slice_counts(r: Roles) -> DataFrame:
    return timeofday.device_slice_counts(r.events())


@query("ordered_slice_counts")
def ordered_slice_counts(r: Roles) -> DataFrame:
    return timeofday.device_slice_counts(r.events()).orderBy("device_id", "slice")


@query("time_histogram")
def time_histogram(r: Roles) -> DataFrame:
    return timeofday.time_histogram(timeofday.device_slice_counts(r.events()))


# -- labels --------------------------------------------------------------------


def _label_counts(r: Roles) -> DataFrame:
    return labels.device_label_counts(r.app_labels(), r.app_events(), r.app_owners())


@query("device_label_apps")
def device_label_apps(r: Roles) -> DataFrame:
    return labels.device_label_apps(r.app_labels(), r.app_events(), r.app_owners())


@query("device_label_counts")
def device_label_counts(r: Roles) -> DataFrame:
    return _label_counts(r)


@query("device_attributes")
def device_attributes(r: Roles) -> DataFrame:
    return attributes.device_attributes(r.train(), r.phones())


@query("device_label_long")
def device_label_long(r: Roles) -> DataFrame:
    known = attributes.device_attributes(r.train(), r.phones())
    return labels.device_label_long(
        known.unionByName(attributes.unlabelled_profile(r.test(), r.phones())), _label_counts(r)
    )


@query("device_label_strings")
def device_label_strings(r: Roles) -> DataFrame:
    return labels.device_label_strings(_label_counts(r))


@query("parse_label_list")
def parse_label_list(r: Roles) -> DataFrame:
    return labels.parse_label_list(labels.device_label_strings(_label_counts(r)))


@query("label_matrix")
def label_matrix(r: Roles) -> DataFrame:
    p = profiles(r)
    return p.base(p.people)


@query("label_categories")
def label_categories(r: Roles) -> DataFrame:
    return labels.with_category(r.app_labels(), r.label_categories())


@query("label_category_counts")
def label_category_counts(r: Roles) -> DataFrame:
    return labels.label_category_counts(r.app_labels(), r.label_categories())


@query("unlabelled_profile")
def unlabelled_profile(r: Roles) -> DataFrame:
    return attributes.unlabelled_profile(r.test(), r.phones())


# -- populations and set operations ----------------------------------------------


@query("full_profile")
def full_profile(r: Roles) -> DataFrame:
    p = profiles(r)
    return p.full(p.people)


@query("empty_profile")
def empty_profile(r: Roles) -> DataFrame:
    p = profiles(r)
    return p.empty(p.people)


@query("all_profile")
def all_profile(r: Roles) -> DataFrame:
    p = profiles(r)
    return p.all(p.people)


@query("all_devices")
def all_devices(r: Roles) -> DataFrame:
    return attributes.all_devices(r.train(), r.test())


@query("devices_without_events")
def devices_without_events(r: Roles) -> DataFrame:
    return population.devices_without_events(r.devices(), r.events())


@query("distinct_devices")
def distinct_devices(r: Roles) -> DataFrame:
    return population.distinct_devices(r.events())


@query("reconcile_counts")
def reconcile_counts(r: Roles) -> DataFrame:
    counts = timeofday.device_slice_counts(r.events())
    return population.reconcile(counts, timeofday.time_histogram(counts))


@query("peek")
def peek(r: Roles) -> DataFrame:
    base = attributes.device_attributes(r.train(), r.phones())
    return population.peek(base, ["phone_brand", "device_model", "device_id"])


# -- location --------------------------------------------------------------------


@query("events_per_device")
def events_per_device(r: Roles) -> DataFrame:
    return location.events_per_device(r.events())


@query("nolocation_per_device")
def nolocation_per_device(r: Roles) -> DataFrame:
    return location.nolocation_per_device(r.events())


@query("assign_clusters")
def assign_clusters(r: Roles) -> DataFrame:
    return location.assign_clusters(r.events(), GRID).select("event_id", "device_id", "cluster")


@query("device_cluster_counts")
def device_cluster_counts(r: Roles) -> DataFrame:
    return location.device_cluster_counts(location.assign_clusters(r.events(), GRID))


@query("cluster_histogram")
def cluster_histogram(r: Roles) -> DataFrame:
    counts = location.device_cluster_counts(location.assign_clusters(r.events(), GRID))
    return location.cluster_histogram(counts, len(GRID))


@query("activity_rollup")
def activity_rollup(r: Roles) -> DataFrame:
    return location.activity_rollup(r.events(), GRID)


@query("outside_vocabulary")
def outside_vocabulary(r: Roles) -> DataFrame:
    """What the registered vocabularies have no column for; profiles refuse to drop it."""
    slices = timeofday.device_slice_counts(r.events())
    found = [
        ("labels", features.outside_vocabulary(_label_counts(r), "label_id", "ile", 1, SPACE.labels)),
        ("first 20 labels", features.outside_vocabulary(_label_counts(r), "label_id", "ile", 1, 20)),
        ("time", features.outside_vocabulary(slices, "slice", "c", 1, SPACE.slices)),
    ]
    named = [df.select(F.lit(name).alias("block"), "*") for name, df in found]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("kmeans_check")
def kmeans_check(r: Roles) -> DataFrame:
    """What holds for any fitted centres: every located event counted, none nearer to another centre."""
    events = r.events().where("longitude is not null and latitude is not null")
    found = location.fit_clusters(events, k=SPACE.clusters, seed=7)
    places = location.assign_clusters(events, found).groupBy("longitude", "latitude", "cluster").agg(
        F.count(F.lit(1)).alias("n")
    )
    centres = F.lit([list(c) for c in found.centres])
    sx, sy = found.scale

    def far(c: F.Column) -> F.Column:
        x, y = (F.col("longitude") - c[0]) / sx, (F.col("latitude") - c[1]) / sy
        return x * x + y * y

    own = far(F.get(centres, F.col("cluster")))
    nearest = F.array_min(F.transform(centres, far))
    return places.select("n", (own > nearest + 1e-9).alias("wrong"), "cluster").agg(
        F.sum("n").alias("n_events"),
        F.count_if("wrong").alias("n_wrong"),
        (F.max("cluster") < SPACE.clusters).alias("within_k"),
    )


@query("kmeans_clusters")
def kmeans_clusters(r: Roles) -> DataFrame:
    events = r.events()
    found = location.fit_clusters(events, k=SPACE.clusters, seed=7)
    sizes = location.assign_clusters(events, found).groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n")
    )
    return found.table(r.spark).join(sizes, "cluster", "left")


@query("furthest_check")
def furthest_check(r: Roles) -> DataFrame:
    """Starts that are the furthest from each other: no two are nearer than any place is to them."""
    events = r.events().where("longitude is not null and latitude is not null")
    points = materialize(events.groupBy(*location.AXES).agg(F.count(F.lit(1)).cast("double").alias("weight")))
    starts = location.furthest_starts(points, 20, 7)
    apart = min((a - c) ** 2 + (b - d) ** 2 for i, (a, b) in enumerate(starts) for c, d in starts[:i])
    gap = points.agg(F.max(location.gap_to(starts))).scalar()
    return r.spark.range(1).select(F.lit(len(starts)).cast("long").alias("n_starts"), (gap <= apart).alias("covered"))


@query("furthest_clusters")
def furthest_clusters(r: Roles) -> DataFrame:
    """The second setting: 100 clusters from the furthest starts, 1,000 rounds at most, in plain degrees."""
    found = location.fit_clusters(r.events(), 100, 7, 1000, standardize=False, init="furthest")
    sizes = location.assign_clusters(r.events(), found).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    return found.table(r.spark).join(sizes, "cluster", "left")


# -- leak study --------------------------------------------------------------------


@query("first_event")
def first_event(r: Roles) -> DataFrame:
    return leak.first_event(r.events())


@query("leak_devices")
def leak_devices(r: Roles) -> DataFrame:
    return leak.leak_devices(r.train(), r.test(), r.phones())


@query("leak_table")
def leak_table(r: Roles) -> DataFrame:
    return leak.leak_table(r.train(), r.test(), r.phones(), r.events())


@query("leak_positions")
def leak_positions(r: Roles) -> DataFrame:
    return leak.leak_positions(r.train(), r.test(), r.phones(), r.events())


# -- feature statistics and scaling -------------------------------------------------


def _label_long(r: Roles) -> DataFrame:
    return features.long_features(_label_counts(r))


@query("feature_stats")
def feature_stats(r: Roles) -> DataFrame:
    return rounded(features.feature_stats(_label_long(r)), "mean")


@query("constant_features")
def constant_features(r: Roles) -> DataFrame:
    return features.constant_features(_label_long(r), VOCABULARY)


@query("drop_constant")
def drop_constant(r: Roles) -> DataFrame:
    long = _label_long(r)
    kept = features.drop_constant(long, features.constant_features(long, VOCABULARY))
    return kept.select("device_id", "feature", "value")


def _factors(r: Roles, long: DataFrame) -> DataFrame:
    """Factors over train and test devices together."""
    known = attributes.all_devices(r.train(), r.test()).select("device_id")
    return features.scale_factors(SPACE.names, long.join(known, "device_id", "left_semi"))


@query("scale_factors")
def scale_factors(r: Roles) -> DataFrame:
    return rounded(_factors(r, profiles(r).long()), "factor")


@query("scaled_features")
def scaled_features(r: Roles) -> DataFrame:
    long = profiles(r).long()
    scaled = features.apply_scale(long, _factors(r, long))
    return rounded(scaled.select("device_id", "feature", "value"), "value")


@query("scaled_profile")
def scaled_profile(r: Roles) -> DataFrame:
    p = profiles(r)
    return rounded(p.scaled(p.people, _factors(r, p.long())), *SPACE.names)


def _device_totals(r: Roles) -> DataFrame:
    events = r.events()
    totals = location.events_per_device(events).join(
        location.nolocation_per_device(events), "device_id", "left"
    )
    return r.devices().select("device_id").join(totals, "device_id", "left")


@query("impute_mean")
def impute_mean(r: Roles) -> DataFrame:
    return rounded(features.impute_mean(_device_totals(r), ["allev", "nolat"]), "allev", "nolat")


@query("standardized")
def standardized(r: Roles) -> DataFrame:
    filled = _device_totals(r).fillna(0, ["allev", "nolat"])
    return rounded(features.standardize(filled, ["allev", "nolat"]), "allev", "nolat")


# -- sources and sinks ----------------------------------------------------------------


@query("csv_round_trip")
def csv_round_trip(r: Roles) -> DataFrame:
    path = scratch_path(r.spark, "events-csv")
    write_csv(r.events(), path)
    return timeofday.events_with_slice(read_table(r.spark, path, "events"))


@query("inferred_csv")
def inferred_csv(r: Roles) -> DataFrame:
    path = scratch_path(r.spark, "totals-csv")
    write_csv(location.events_per_device(r.events()), path)
    return read_inferred(r.spark, path).select(
        F.col("device_id").cast("bigint"), F.col("allev").cast("bigint")
    )


@query("materialized_split")
def materialized_split(r: Roles) -> DataFrame:
    train, _ = split.hash_split(r.devices(), 0.9, seed=1)
    return materialize(train)


# -- models ------------------------------------------------------------------------------


@query("hash_split")
def hash_split(r: Roles) -> DataFrame:
    train, valid = split.hash_split(r.devices().select("device_id"), 0.9, seed=1)
    return train.withColumn("part", F.lit("train")).unionByName(
        valid.withColumn("part", F.lit("valid"))
    )


@query("nb_class_stats")
def nb_class_stats(r: Roles) -> DataFrame:
    stats = scoring.class_stats(_label_long(r), r.train(), SPACE.label_names)
    return rounded(stats, "mean", "variance")


@query("nb_label_scores")
def nb_label_scores(r: Roles) -> DataFrame:
    train, test = profiles(r).model_frames()
    model = fit.fit_naive_bayes(train, fit.Inputs(("labels",), (), ()), GROUPS)
    return rounded(scoring.submission(model, test, GROUPS), *GROUPS)


@query("nb_scores")
def nb_scores(r: Roles) -> DataFrame:
    train, test = profiles(r).model_frames()
    return scoring.submission(fit.fit_naive_bayes(train, fit.BASE_INPUTS, GROUPS), test, GROUPS)


@query("forest_scores")
def forest_scores(r: Roles) -> DataFrame:
    train, test = profiles(r).model_frames()
    model = fit.fit_forest(train, fit.ALL_INPUTS, GROUPS, fit.Forest(20, 5), seed=7)
    return scoring.submission(model, test, GROUPS)


@query("forest_importances")
def forest_importances(r: Roles) -> DataFrame:
    train, _ = profiles(r).model_frames()
    model = fit.fit_forest(train, fit.ALL_INPUTS, GROUPS, fit.Forest(20, 5), seed=7)
    return fit.importances(model, fit.ALL_INPUTS, SPACE, train)


@query("mlp_scores")
def mlp_scores(r: Roles) -> DataFrame:
    """The library's perceptron, with the six layers of 64 that the network of all devices has, and at most 500 iterations."""
    train, test = profiles(r).model_frames()
    model = fit.fit_mlp(train, fit.ALL_INPUTS, GROUPS, fit.NETWORKS["all"], seed=7)
    return scoring.submission(model, test, GROUPS)


#: Registered networks have all their layers and end after this many epochs without gain.
PERSON = replace(fit.TRAININGS["person"], patience=8)


def _network(train: DataFrame) -> PipelineModel:
    return fit.fit_network(train, fit.ALL_INPUTS, GROUPS, fit.NETWORKS["all"], seed=7)


@query("network_scores")
def network_scores(r: Roles) -> DataFrame:
    """Six layers of 64 with dropout and penalties, at most 500 epochs, stopped after 42 without gain."""
    train, test = profiles(r).model_frames()
    return scoring.submission(_network(train), test, GROUPS)


@query("network_curve")
def network_curve(r: Roles) -> DataFrame:
    train, _ = profiles(r).model_frames()
    return fit.loss_curve(_network(train), train)


@query("age_scores")
def age_scores(r: Roles) -> DataFrame:
    """Ages by three layers of 64."""
    train, test = profiles(r).model_frames()
    model = fit.fit_age_network(train, seed=7)
    cast = test.withColumns({c: F.col(c).cast("double") for c in fit.PERSON_INPUTS.numbers})
    return model.transform(cast).select("device_id", "age_prediction")


@query("fit_inputs")
def fit_inputs(r: Roles) -> DataFrame:
    """The labels that a fit takes as inputs: those that vary over its training rows."""
    train, _ = profiles(r).model_frames()
    inputs = fit.Inputs(("labels",), (), ())
    stages = fit.feature_stages(inputs)
    names = fit.fitted_names(Pipeline(stages=stages).fit(train), inputs, SPACE)
    return features.vocabulary(r.spark, names)


def _stacked(train: DataFrame) -> stacking.StackedModel:
    return stacking.fit_stacked(
        train,
        GROUPS,
        folds=2,
        seed=7,
        size=fit.Network((8,), 20),
        age_fit=lambda df: fit.fit_age_network(df, seed=7, how=PERSON),
        gender_fit=lambda df: fit.fit_gender(df, size=fit.Network((8,), 20), seed=7),
    )


@query("stacked_scores")
def stacked_scores(r: Roles) -> DataFrame:
    train, test = profiles(r).model_frames()
    return scoring.submission(_stacked(train), test, GROUPS)


@query("submission")
def submission(r: Roles) -> DataFrame:
    """Scores from a model that went through storage."""
    train, test = profiles(r).model_frames()
    model = fit.fit_forest(train, fit.EMPTY_INPUTS, GROUPS, fit.Forest(20, 5), seed=7)
    path = save_model(model, scratch_path(r.spark, "model"), stamp=True)
    return scoring.submission(load_model(path), test, GROUPS)


@query("grid_search")
def grid_search(r: Roles) -> DataFrame:
    train, _ = profiles(r).model_frames()
    return fit.grid_search(train, fit.BASE_INPUTS, GROUPS, trees=(5, 10), depths=(3, 5), seed=7)


def _full_scores(r: Roles) -> DataFrame:
    """Devices with activity, on attributes, labels and time of day."""
    train, test = profiles(r).model_frames(active=True)
    model = fit.fit_mlp(train, fit.FULL_INPUTS, GROUPS, fit.Network((16, 8), 30), seed=7)
    return scoring.submission(model, test, GROUPS)


@query("full_submission")
def full_submission(r: Roles) -> DataFrame:
    return _full_scores(r)


@query("mlp_importances")
def mlp_importances(r: Roles) -> DataFrame:
    train, _ = profiles(r).model_frames()
    model = fit.fit_mlp(train, fit.BASE_INPUTS, GROUPS, fit.Network((16, 8), 30), seed=7)
    return fit.network_importances(model, fit.BASE_INPUTS, SPACE, train)


def _totals(scores: DataFrame) -> DataFrame:
    """Scored devices with the sum of their probabilities, which SQL knows without the model."""
    total = sum((F.col(f"`{g}`") for g in GROUPS), F.lit(0.0))
    return scores.select("device_id", F.round(total, DIGITS).alias("total"))


for _name, _scores in [
    ("nb", nb_scores), ("forest", forest_scores), ("mlp", mlp_scores), ("stacked", stacked_scores),
    ("submission", submission), ("full", _full_scores), ("network", network_scores),
]:
    query(f"{_name}_totals")(lambda r, scores=_scores: _totals(scores(r)))


@query("importance_total")
def importance_total(r: Roles) -> DataFrame:
    return forest_importances(r).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("importance"), DIGITS).alias("total")
    )


@query("grid_settings")
def grid_settings(r: Roles) -> DataFrame:
    """All settings of the grid, each with a finite loss."""
    return grid_search(r).select("trees", "depth", (F.col("logloss") > 0).alias("scored"))


@query("prior_submission")
def prior_submission(r: Roles) -> DataFrame:
    p = profiles(r)
    scored = scoring.prior_submission(p.train_attributes, p.test_attributes, "brand", GROUPS)
    return rounded(scored, *GROUPS)


@query("prior_logloss")
def prior_logloss(r: Roles) -> DataFrame:
    base = profiles(r).train_attributes
    scored = scoring.prior_submission(base, base, "brand", GROUPS, keep=["grp"])
    return rounded(scoring.evaluate(scored, "grp", GROUPS), "logloss", "mse", "r2")
