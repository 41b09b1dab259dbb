"""Batch stages from CSV inputs to profiles, models and submissions.

Each stage reads files and writes files, so stages can run on different days or
clusters. Long tables pass between stages as Parquet; wide tables are CSV exports.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from devfold.models import fit, scoring, split, stacking
from devfold.models.network import Training
from devfold.models.vectors import block_means, fill_blocks, profile_vectors
from devfold.operators import attributes, features, labels, leak, location, population, timeofday
from devfold.schemas import CLASSES, FeatureSpace
from devfold.session import materialize
from devfold.sources import read_table, save_model, write_csv

PARTS = ("train", "test")

# Output names under which other tools expect the files of a run:
# timeevents, dev_app_*, events_noEvents, events_nolat, events_clusters, full_*, empty_*, all_*, submit_*.


@dataclass(frozen=True)
class Run:
    """One run: where files come from, where they go, and every size that matters."""

    spark: SparkSession
    inputs: str
    outputs: str
    space: FeatureSpace = FeatureSpace()
    classes: tuple[str, ...] = tuple(CLASSES)
    forests: dict[str, fit.Forest] = field(default_factory=lambda: dict(fit.FORESTS))
    networks: dict[str, fit.Network] = field(default_factory=lambda: dict(fit.NETWORKS))
    trainings: dict[str, Training] = field(default_factory=lambda: dict(fit.TRAININGS))
    folds: int = 3
    #: Boosted trees of the age model; without a number it is a network.
    age_trees: int | None = None
    seed: int = 17

    # -- files -------------------------------------------------------------------

    def source(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.inputs}/{name}.csv", name)

    def load(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.outputs}/{name}.parquet")

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, f"{self.outputs}/{name}.parquet")

    def export(self, df: DataFrame, name: str) -> None:
        write_csv(df, f"{self.outputs}/{name}")

    def save(self, model: PipelineModel, name: str) -> str:
        return save_model(model, f"{self.outputs}/models/{name}-", stamp=True)

    # -- feature stages --------------------------------------------------------------

    def time_events(self) -> None:
        """Events to slice counts and the time-of-day histogram."""
        counts = self.keep(timeofday.device_slice_counts(self.source("events")), "slice_counts")
        self.export(timeofday.time_histogram(counts, self.space.slices), "timeevents")

    def cluster_events(self) -> None:
        """Events to totals, location clusters and cluster counts."""
        events = self.source("events")
        found = location.fit_clusters(events, self.space.clusters, self.seed)
        self.export(found.table(self.spark), "cluster_centres")
        rollup = materialize(location.activity_rollup(events, found))
        totals = self.keep(location.rollup_totals(rollup), "totals")
        counts = self.keep(location.rollup_clusters(rollup), "cluster_counts")
        self.export(totals.select("device_id", "allev"), "events_noEvents")
        self.export(totals.select("device_id", "nolat").dropna(), "events_nolat")
        self.export(counts, "events_time_cluster")
        self.export(location.cluster_histogram(counts, self.space.clusters), "events_clusters")

    def munge(self) -> None:
        """Label counts, attributes and base profiles of train and test devices."""
        counts = self.keep(
            labels.device_label_counts(
                self.source("app_labels"), self.source("app_events"), self.source("events")
            ),
            "label_counts",
        )
        phones = self.source("phone_brand_device_model")
        test = attributes.with_missing_labels(self.source("gender_age_test"))
        for part, devices in zip(PARTS, (self.source("gender_age_train"), test)):
            base = self.keep(attributes.base_attributes(devices, phones), f"attributes_{part}")
            wide = labels.label_matrix(base, counts, self.space.labels)
            self.export(wide, f"dev_app_{part}")

    def merge(self) -> None:
        """Devices with activity (full) and without (empty)."""
        counts = self.load("slice_counts")
        blocks = [
            labels.label_block(self.load("label_counts"), self.space.labels),
            timeofday.time_block(counts, self.space.slices),
        ]
        for part in PARTS:
            known = self.load(f"attributes_{part}")
            active = population.active_devices(known, counts)
            self.export(features.attach_blocks(active, *blocks), f"full_{part}")
            self.export(population.empty_profile(known, counts), f"empty_{part}")

    def _long(self) -> DataFrame:
        return features.long_features(
            *(self.load(n) for n in ("label_counts", "slice_counts", "totals", "cluster_counts"))
        )

    def _devices(self) -> DataFrame:
        ids = [self.load(f"attributes_{part}").select("device_id") for part in PARTS]
        return ids[0].unionByName(ids[1])

    def merge_all(self) -> None:
        """All devices with all blocks, scaled by factors over train and test."""
        known = self._long().join(self._devices(), "device_id", "left_semi")
        factors = self.keep(features.scale_factors(self.space.names, known), "scale_factors")
        blocks = [
            labels.label_block(self.load("label_counts"), self.space.labels),
            timeofday.time_block(self.load("slice_counts"), self.space.slices),
            *location.total_blocks(self.load("totals")),
            location.cluster_block(self.load("cluster_counts"), self.space.clusters),
        ]
        for part in PARTS:
            wide = features.attach_scaled_blocks(self.load(f"attributes_{part}"), factors, *blocks)
            self.export(wide, f"all_{part}")

    def normalization(self) -> None:
        """Label statistics of the training devices, and the labels that never vary."""
        train = self.load("attributes_train").select("device_id")
        long = features.long_features(self.load("label_counts")).join(train, "device_id", "left_semi")
        self.export(features.feature_stats(long), "label_stats")
        self.export(features.constant_features(long, self.space.label_names), "constant_labels")

    def leak(self) -> None:
        """The ordering study."""
        table = leak.leak_table(
            self.source("gender_age_train"),
            self.source("gender_age_test"),
            self.source("phone_brand_device_model"),
            self.source("events"),
        )
        self.export(table, "leak")

    # -- model stages ------------------------------------------------------------------

    def _vectors(self, part: str) -> DataFrame:
        return profile_vectors(
            self.load(f"attributes_{part}"),
            *(self.load(n) for n in ("label_counts", "slice_counts", "totals", "cluster_counts")),
            self.space,
        )

    def _frames(self, active: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Train, validation and test vectors, of devices with activity only if wanted; means come from those training rows alone."""
        parts = [self._vectors(part) for part in PARTS]
        if active:
            parts = [population.active_devices(df, self.load("slice_counts")) for df in parts]
        known, test = map(materialize, parts)
        train, valid = split.hash_split(known, 0.9, self.seed)
        means = block_means(train)
        return fill_blocks(train, means), fill_blocks(valid, means), fill_blocks(test, means)

    def _publish(
        self, model: PipelineModel | stacking.StackedModel, valid: DataFrame, test: DataFrame, name: str
    ) -> None:
        """Submission of the test devices and quality on the validation devices."""
        self.export(scoring.submission(model, test, self.classes), f"submit_{name}")
        scored = scoring.submission(model, valid, self.classes, keep=["grp"])
        self.export(scoring.evaluate(scored, "grp", self.classes), f"quality_{name}")

    def model_full(self) -> None:
        """Perceptron on attributes, labels and time of day, for the devices with activity."""
        train, valid, test = self._frames(active=True)
        size = self.networks["full"]
        model = fit.fit_mlp(train, fit.FULL_INPUTS, self.classes, size, self.seed)
        self.save(model, "full")
        self._publish(model, valid, test, "full")

    def model_empty(self) -> None:
        """Forest on attributes alone, for devices without activity."""
        counts = self.load("slice_counts")
        known, test = (
            population.empty_profile(self.load(f"attributes_{p}"), counts) for p in PARTS
        )
        train, valid = split.hash_split(materialize(known), 0.9, self.seed)
        size = self.forests["empty"]
        model = fit.fit_forest(train, fit.EMPTY_INPUTS, self.classes, size, self.seed)
        self.save(model, "empty")
        self._publish(model, valid, test, "empty")

    def model_all(self) -> None:
        """Network with dropout on everything but the clusters, stopped on the validation devices; its losses are a table."""
        train, valid, test = self._frames()
        size, how = self.networks["all"], self.trainings["all"]
        model = fit.fit_network(train, fit.ALL_INPUTS, self.classes, size, self.seed, how=how, valid=valid)
        self.save(model, "all")
        self.export(fit.loss_curve(model, train), "losses_all")
        self._publish(model, valid, test, "all")

    def model_bayes(self) -> None:
        """Gaussian naive Bayes on attributes and labels."""
        train, valid, test = self._frames()
        model = fit.fit_naive_bayes(train, fit.BASE_INPUTS, self.classes)
        self.save(model, "bayes")
        self._publish(model, valid, test, "bayes")

    def model_stacked(self) -> None:
        """Age and gender first, then the group with both as inputs."""
        train, valid, test = self._frames()
        person, how = self.networks["person"], self.trainings["person"]

        def age(df: DataFrame) -> PipelineModel:
            if self.age_trees is not None:
                return fit.fit_age(df, trees=self.age_trees, seed=self.seed)
            return fit.fit_age_network(df, size=person, seed=self.seed, how=how)

        model = stacking.fit_stacked(
            train,
            self.classes,
            self.folds,
            self.seed,
            self.networks["stacked"],
            age_fit=age,
            gender_fit=lambda df: fit.fit_gender_network(df, size=person, seed=self.seed, how=how),
        )
        model.save(f"{self.outputs}/models/stacked")
        self._publish(model, valid, test, "stacked")


STAGES: dict[str, Callable[[Run], None]] = {
    "time_events": Run.time_events,
    "cluster_events": Run.cluster_events,
    "munge": Run.munge,
    "merge": Run.merge,
    "merge_all": Run.merge_all,
    "normalization": Run.normalization,
    "leak": Run.leak,
    "model_bayes": Run.model_bayes,
    "model_full": Run.model_full,
    "model_empty": Run.model_empty,
    "model_all": Run.model_all,
    "model_stacked": Run.model_stacked,
}
