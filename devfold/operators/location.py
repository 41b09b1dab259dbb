"""Where events happen: missing locations, location clusters, counts per device."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devfold.functions import time_slice
from devfold.operators.features import Block, widen
from devfold.schemas import CLUSTERS, TOTALS, FeatureSpace
from devfold.session import materialize

AXES = ["longitude", "latitude"]
DISTANCES_AT_ONCE = 100_000
#: Points in one tile, tiles that one task of a round reads, and tasks of a round at most (they read more tiles then).
TILE, TASK_TILES, MOST_TASKS = 512, 128, 4096


def nowhere() -> Column:
    """True for an event whose location was not recorded (both coordinates 0)."""
    return (F.col("latitude") == 0) & (F.col("longitude") == 0)


def without_location(events: DataFrame) -> DataFrame:
    return events.where(nowhere())


def events_per_device(events: DataFrame) -> DataFrame:
    return events.groupBy("device_id").agg(F.count(F.lit(1)).alias("allev"))


def nolocation_per_device(events: DataFrame) -> DataFrame:
    """Devices with at least one event that has no location, and how many."""
    return without_location(events).groupBy("device_id").agg(F.count(F.lit(1)).alias("nolat"))


# -- clusters ------------------------------------------------------------------


@dataclass(frozen=True)
class Clusters:
    """Cluster centres in degrees, and the scale distances are measured in."""

    centres: list[tuple[float, float]]
    scale: tuple[float, float] = (1.0, 1.0)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(self.centres)]
        return spark.createDataFrame(rows, "cluster int, longitude double, latitude double")


def fit_clusters(
    events: DataFrame,
    k: int = CLUSTERS,
    seed: int = 0,
    max_iter: int = 20,
    standardize: bool = True,
    init: str = "parallel",
) -> Clusters:
    """K-means over event locations.

    ``init`` is ``parallel`` (sampled starts) or ``furthest`` (see ``furthest_starts``).

    Events at one place collapse to a single weighted point first, so a place that
    holds a large share of the events costs no more than any other. The points are
    written once, so raw events are scanned once however many rounds follow. A
    coordinate that never changes takes no part.
    """
    located = F.col(AXES[0]).isNotNull() & F.col(AXES[1]).isNotNull()
    points = materialize(
        events.groupBy(*AXES)
        .agg(F.count_if(located).cast("double").alias("weight"))
        .where("weight > 0")
    )
    n = F.sum("weight")
    facts = points.agg(*[f for c in AXES for f in _weighted(c, n)]).head()
    if facts[f"lo_{AXES[0]}"] is None:
        raise ValueError("no event has a location")
    varying = [c for c in AXES if facts[f"lo_{c}"] < facts[f"hi_{c}"]]
    fixed = {c: facts[f"lo_{c}"] for c in AXES if c not in varying}
    scale = {c: facts[f"sd_{c}"] if standardize and c in varying else 1.0 for c in AXES}
    if not varying:
        return Clusters([tuple(fixed[c] for c in AXES)])
    shifted = points.select(
        *[((F.col(c) - facts[f"mid_{c}"]) / scale[c]).alias(c) for c in varying], "weight"
    )
    if init == "furthest":
        place = points.select(
            *[((F.col(c) - facts[f"mid_{c}"]) / scale[c] if c in varying else F.lit(0.0)).alias(c) for c in AXES], "weight"
        )
        place = materialize(place)
        found = settle(place, furthest_starts(place, k, seed), max_iter)
        mids = [facts[f"mid_{c}"] if c in varying else fixed[c] for c in AXES]
        sizes = (float(scale[AXES[0]]), float(scale[AXES[1]]))
        return Clusters([(x * sizes[0] + mids[0], y * sizes[1] + mids[1]) for x, y in found], sizes)
    if init != "parallel":
        raise ValueError(f"init is parallel or furthest: {init}")
    packed = VectorAssembler(inputCols=varying, outputCol="features").transform(shifted)
    model = KMeans(k=k, seed=seed, maxIter=max_iter, weightCol="weight").fit(packed)
    centres = []
    for centre in model.clusterCenters():
        found = {c: v * scale[c] + facts[f"mid_{c}"] for c, v in zip(varying, centre)}
        centres.append(tuple(float({**found, **fixed}[c]) for c in AXES))
    return Clusters(centres, (float(scale[AXES[0]]), float(scale[AXES[1]])))


def _weighted(c: str, n: Column) -> list[Column]:
    """Range, mean and sample deviation of a coordinate over weighted points."""
    mid = F.sum(F.col("weight") * F.col(c)) / n
    square = F.sum(F.col("weight") * F.col(c) * F.col(c)) - n * mid * mid
    return [
        F.min(c).alias(f"lo_{c}"),
        F.max(c).alias(f"hi_{c}"),
        mid.alias(f"mid_{c}"),
        F.sqrt(F.greatest(F.try_divide(square, n - 1), F.lit(0.0))).alias(f"sd_{c}"),
    ]


def furthest_starts(points: DataFrame, k: int, seed: int = 0) -> list[tuple[float, float]]:
    """Up to ``k`` points, each the furthest from those chosen before it; fewer where there are fewer distinct ones.

    The first is the one with the smallest seeded hash; equally far points go by their coordinates. Each round is one
    stage over tiles of neighbouring points (see ``tiled``), which only sends the best point of every task.
    """
    points = materialize(points.select(*AXES, "weight"))
    first = F.struct(F.xxhash64(F.lit(seed), *AXES).alias("h"), *AXES)
    start = points.agg(F.min(first).alias("x")).select("x.*").head()
    if start.h is None:
        return []
    chosen = [(start[AXES[0]], start[AXES[1]])]
    tiles, tasks = tiled(points)
    while len(chosen) < k:
        found = tiles.coalesce(tasks).mapInArrow(_tile_furthest(np.array(chosen)), "gap double, x double, y double").collect()
        best = max(((r.gap, -r.x, -r.y) for r in found), default=(0.0, 0.0, 0.0))
        if best[0] <= 0:
            break
        chosen.append((0.0 - best[1], 0.0 - best[2]))
    return chosen


def gap_to(centres: Sequence[tuple[float, float]]) -> Column:
    """Squared distance of a point to the nearest centre."""
    known = np.asarray(centres, dtype=float)
    rows = max(1, DISTANCES_AT_ONCE // len(known))

    @F.arrow_udf("double")
    def gap(longitude: pa.Array, latitude: pa.Array) -> pa.Array:
        x, y = (v.to_numpy(zero_copy_only=False) for v in (longitude, latitude))
        out = np.empty(len(x))
        for at in range(0, len(x), rows):
            dx = x[at : at + rows, None] - known[None, :, 0]
            dy = y[at : at + rows, None] - known[None, :, 1]
            out[at : at + rows] = (dx * dx + dy * dy).min(axis=1)
        return pa.array(out)

    return gap(*AXES)


def settle(
    points: DataFrame, starts: Sequence[tuple[float, float]], max_iter: int, tolerance: float = 1e-9
) -> list[tuple[float, float]]:
    """Centres after moving each to the weighted mean of the points nearest to it, until none moves further than ``tolerance``.

    A centre without points stays. A round is one stage over tiles of neighbouring points (see ``tiled``), which sends the
    sums of each task; the lower centre wins a tie.
    """
    centres = [tuple(map(float, c)) for c in starts]
    if not centres or max_iter < 1:
        return centres
    tiles, tasks = tiled(points)
    for _ in range(max_iter):
        found = tiles.coalesce(tasks).mapInArrow(_tile_sums(np.array(centres)), "sums binary").collect()
        sums = sum((np.frombuffer(r.sums) for r in found), np.zeros(3 * len(centres))).reshape(3, -1)
        new = [(x / n, y / n) if n else c for c, (n, x, y) in zip(centres, sums.T.tolist())]
        shift = max((a - c) ** 2 + (b - d) ** 2 for (a, b), (c, d) in zip(new, centres))
        centres = new
        if shift <= tolerance * tolerance:
            break
    return centres


def tiled(points: DataFrame) -> tuple[DataFrame, int]:
    """All points as tiles of up to ``TILE`` neighbours, written once, and the number of tasks a round over them takes.

    A tile has its bounds, the weight and the weighted sums of its points, and the points themselves as plain bytes.
    Neighbours follow each other in Morton order, which sampled ranges deal to tasks; any order gives the same rounds.
    """
    facts = points.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for c in AXES for f in (F.min, F.max)]).head()
    low = np.array([facts[f"min_{c}"] or 0.0 for c in AXES])
    reach = np.array([(facts[f"max_{c}"] or 0.0) for c in AXES]) - low
    reach = np.where(reach > 0, reach, 1.0)
    tasks = min(MOST_TASKS, max(1, -(-facts.n // (TILE * TASK_TILES))))

    @F.arrow_udf("long")
    def place(longitude: pa.Array, latitude: pa.Array) -> pa.Array:
        code = np.zeros(len(longitude), np.int64)
        for axis, values in enumerate((longitude, latitude)):
            at = ((values.to_numpy(zero_copy_only=False) - low[axis]) / reach[axis] * 65535).astype(np.int64)
            for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
                at = (at | (at << shift)) & mask
            code |= at << axis
        return pa.array(code)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TILE):
                x, y, w = (c.to_numpy(zero_copy_only=False) for c in whole.slice(at, TILE).columns[:3])
                facts = [x.min(), x.max(), y.min(), y.max(), w.sum(), (w * x).sum(), (w * y).sum()]
                cells = [np.array(facts).tobytes(), np.concatenate([x, y, w]).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], names=["facts", "points"])

    dealt = points.select(*AXES, "weight", place(*AXES).alias("code")).repartitionByRange(tasks, "code").sortWithinPartitions("code")
    return materialize(dealt.mapInArrow(cut, "facts binary, points binary")), tasks


def _bounds(facts: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each tile and centre, squared distances that no point of the tile is nearer than, and none further."""
    near, far = np.zeros((2, len(facts), len(centres)))
    for axis in (0, 1):
        below = facts[:, 2 * axis, None] - centres[None, :, axis]
        above = centres[None, :, axis] - facts[:, 2 * axis + 1, None]
        near += np.maximum(np.maximum(below, above), 0) ** 2
        far += np.minimum(below, above) ** 2
    return near, far


def _tile_furthest(centres: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For tiles, one row: the point furthest from its nearest centre, by squared distance, the smallest of equal ones.

    Only tiles that may hold one further away than the best so far are opened.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = (-1.0, 0.0, 0.0)
        for batch in batches:
            facts = np.frombuffer(b"".join(batch.column(0).to_pylist())).reshape(-1, 7)
            most = _bounds(facts, centres)[1].min(axis=1) * (1 + 1e-9)
            for tile in np.argsort(-most):
                if most[tile] < best[0]:
                    break
                x, y, _ = np.frombuffer(batch.column(1)[int(tile)].as_py()).reshape(3, -1)
                dx, dy = x[:, None] - centres[None, :, 0], y[:, None] - centres[None, :, 1]
                gap = (dx * dx + dy * dy).min(axis=1)
                at = np.flatnonzero(gap == gap.max())
                best = max(best, *zip(gap[at].tolist(), (-x[at]).tolist(), (-y[at]).tolist()))
        if best[0] >= 0:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (best[0], -best[1], -best[2])], names=["gap", "x", "y"])

    return work


def _tile_sums(centres: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For tiles, one row: weight and weighted sums of the points nearest to each centre.

    A centre that is further from every point of a tile than another one is not compared with its points; where one centre is left, it
    takes the tile as a whole.
    """
    k = len(centres)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, k))
        for batch in batches:
            facts = np.frombuffer(b"".join(batch.column(0).to_pylist())).reshape(-1, 7)
            near, far = _bounds(facts, centres)
            open_ = near <= far.min(axis=1, keepdims=True) * (1 + 1e-9)
            alone = open_.sum(axis=1) == 1
            owner = open_[alone].argmax(axis=1)
            for i in range(3):
                total[i] += np.bincount(owner, facts[alone, 4 + i], k)
            for tile in np.flatnonzero(~alone):
                x, y, w = np.frombuffer(batch.column(1)[int(tile)].as_py()).reshape(3, -1)
                left = np.flatnonzero(open_[tile])
                dx, dy = x[:, None] - centres[None, left, 0], y[:, None] - centres[None, left, 1]
                owner = left[np.argmin(dx * dx + dy * dy, axis=1)]
                for i, values in enumerate((w, w * x, w * y)):
                    total[i] += np.bincount(owner, values, k)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return work


def nearest_cluster(clusters: Clusters | Sequence[tuple[float, float]]) -> Column:
    """Number of the nearest centre, the lower one on a tie, null without a location.

    Centres are a model of k rows, so they travel with the task. Each Arrow batch is
    reduced to its distinct places and compared in pieces that stay in cache.
    """
    if not isinstance(clusters, Clusters):
        clusters = Clusters(list(clusters))
    centres = np.asarray(clusters.centres, dtype=float)
    scale = np.asarray(clusters.scale, dtype=float)
    rows = max(1, DISTANCES_AT_ONCE // len(centres))

    @F.arrow_udf("int")
    def nearest(longitude: pa.Array, latitude: pa.Array) -> pa.Array:
        x = longitude.to_numpy(zero_copy_only=False).astype(float)
        y = latitude.to_numpy(zero_copy_only=False).astype(float)
        missing = np.isnan(x) | np.isnan(y)
        places, back = np.unique(np.where(missing, 0, x + 1j * y), return_inverse=True)
        best = np.empty(len(places), dtype="int32")
        for at in range(0, len(places), rows):
            part = places[at : at + rows, None]
            dx = (part.real - centres[None, :, 0]) / scale[0]
            dy = (part.imag - centres[None, :, 1]) / scale[1]
            best[at : at + rows] = np.argmin(dx * dx + dy * dy, axis=1)
        return pa.array(best[back], mask=missing)

    return nearest(*AXES)


def assign_clusters(
    events: DataFrame, clusters: Clusters | Sequence[tuple[float, float]]
) -> DataFrame:
    """Events with the number of their nearest centre; a map-only step."""
    return events.withColumn("cluster", nearest_cluster(clusters))


def device_cluster_counts(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("device_id", "cluster").agg(F.count(F.lit(1)).alias("n"))


def cluster_histogram(cluster_counts: DataFrame, k: int = CLUSTERS) -> DataFrame:
    """One row per device with ``c0..c{k-1}``, sized by k and not by the centres found."""
    return widen(cluster_counts, "cluster", "n", {i: f"c{i}" for i in range(k)})


def cluster_block(cluster_counts: DataFrame, k: int = CLUSTERS) -> Block:
    return Block(cluster_counts, "n", FeatureSpace(clusters=k).cluster_names, key="cluster")


def total_blocks(totals: DataFrame) -> list[Block]:
    """One block per total, since a device may have events and yet no ``nolat``."""
    return [Block(totals, name, [name]) for name in TOTALS]


# -- one pass for everything ---------------------------------------------------


def activity_rollup(
    events: DataFrame, clusters: Clusters | Sequence[tuple[float, float]]
) -> DataFrame:
    """Events per device, slice, cluster and presence of a location.

    The finest table the profile blocks need: slice counts, cluster counts and
    totals are sums over it, so raw events are scanned and shuffled once.
    """
    rows = assign_clusters(events.dropna(how="all"), clusters)
    return rows.groupBy(
        "device_id",
        time_slice("ts").alias("slice"),
        "cluster",
        nowhere().alias("nowhere"),
    ).agg(F.count(F.lit(1)).alias("n"))


def rollup_slices(rollup: DataFrame) -> DataFrame:
    """Events per device and slice. A device has at most as many rows as slices and clusters allow, so they are dealt by device."""
    return rollup.repartition("device_id").groupBy("device_id", "slice").agg(F.sum("n").alias("c"))


def rollup_clusters(rollup: DataFrame) -> DataFrame:
    """Events per device and cluster, dealt by device like the slices."""
    return rollup.repartition("device_id").groupBy("device_id", "cluster").agg(F.sum("n").alias("n"))


def rollup_totals(rollup: DataFrame) -> DataFrame:
    """``allev`` and ``nolat`` per device; ``nolat`` is null where every event has a location."""
    lost = F.sum(F.when(F.col("nowhere"), F.col("n")))
    return rollup.groupBy("device_id").agg(F.sum("n").alias("allev"), lost.alias("nolat"))
