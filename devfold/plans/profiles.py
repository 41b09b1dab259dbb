"""From source frames to device profiles."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from devfold.models.vectors import block_means, fill_blocks, profile_vectors
from devfold.operators import attributes, features, labels, location, population, timeofday
from devfold.operators.location import Clusters
from devfold.schemas import FeatureSpace
from devfold.session import materialize


@dataclass(frozen=True)
class Sources:
    """The input frames of a profile run.

    ``app_owners`` tells which device an app event came from; where one event table
    serves both purposes it is simply ``events`` again.
    """

    train: DataFrame
    test: DataFrame
    phones: DataFrame
    events: DataFrame
    app_events: DataFrame
    app_owners: DataFrame
    app_labels: DataFrame


class Profiles:
    """Lazily declared blocks over one set of sources; nothing runs until it is read."""

    def __init__(
        self,
        sources: Sources,
        space: FeatureSpace,
        clusters: Clusters | Sequence[tuple[float, float]],
    ):
        self.sources = sources
        self.space = space
        self.clusters = clusters

    @cached_property
    def label_counts(self) -> DataFrame:
        s = self.sources
        return labels.device_label_counts(s.app_labels, s.app_events, s.app_owners)

    @cached_property
    def rollup(self) -> DataFrame:
        """Written once, since three blocks are sums over it."""
        return materialize(location.activity_rollup(self.sources.events, self.clusters))

    @cached_property
    def slice_counts(self) -> DataFrame:
        return location.rollup_slices(self.rollup)

    @cached_property
    def totals(self) -> DataFrame:
        return location.rollup_totals(self.rollup)

    @cached_property
    def cluster_counts(self) -> DataFrame:
        return location.rollup_clusters(self.rollup)

    @cached_property
    def train_attributes(self) -> DataFrame:
        return attributes.base_attributes(self.sources.train, self.sources.phones)

    @cached_property
    def test_attributes(self) -> DataFrame:
        unlabelled = attributes.with_missing_labels(self.sources.test)
        return attributes.base_attributes(unlabelled, self.sources.phones)

    @cached_property
    def people(self) -> DataFrame:
        """Train and test devices; the latter have neither gender, age nor group."""
        return self.train_attributes.unionByName(self.test_attributes)

    def base(self, attrs: DataFrame) -> DataFrame:
        return labels.label_matrix(attrs, self.label_counts, self.space.labels)

    def full(self, attrs: DataFrame) -> DataFrame:
        counts = timeofday.device_slice_counts(self.sources.events)
        return features.attach_blocks(
            population.active_devices(attrs, counts),
            labels.label_block(self.label_counts, self.space.labels),
            timeofday.time_block(counts, self.space.slices),
        )

    def empty(self, attrs: DataFrame) -> DataFrame:
        return population.empty_profile(attrs, self.sources.events)

    def scaled(self, attrs: DataFrame, factors: DataFrame) -> DataFrame:
        """:meth:`all` with each column divided by its factor."""
        return features.attach_scaled_blocks(attrs, factors, *self._blocks())

    def all(self, attrs: DataFrame) -> DataFrame:
        return features.attach_blocks(attrs, *self._blocks())

    def _blocks(self) -> list[features.Block]:
        return [
            labels.label_block(self.label_counts, self.space.labels),
            timeofday.time_block(self.slice_counts, self.space.slices),
            *location.total_blocks(self.totals),
            location.cluster_block(self.cluster_counts, self.space.clusters),
        ]

    @cached_property
    def _long(self) -> DataFrame:
        return materialize(
            features.long_features(
                self.label_counts, self.slice_counts, self.totals, self.cluster_counts
            )
        )

    def long(self) -> DataFrame:
        """All blocks in long form, written once: factors and values are both read from it."""
        return self._long

    def model_frames(self, active: bool = False) -> tuple[DataFrame, DataFrame]:
        """Train and test vectors, of devices with activity only if wanted; missing blocks have the means of those training rows.

        Written once: every fit below reads its columns several times.
        """
        vectors = profile_vectors(
            self.people,
            self.label_counts,
            self.slice_counts,
            self.totals,
            self.cluster_counts,
            self.space,
        )
        vectors = materialize(population.active_devices(vectors, self.slice_counts) if active else vectors)
        train, test = vectors.where("grp is not null"), vectors.where("grp is null")
        means = block_means(train)
        return fill_blocks(train, means), fill_blocks(test, means)
