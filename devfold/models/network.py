"""Networks with tanh layers, dropout and weight penalties, stopped when a held-out part gains no more.

A step is one Spark job: the weights are broadcast, every task adds up the gradient of its rows, a few rows at a
time as dense matrices, the sums are added in groups of ``FAN``, and the driver moves the weights. What travels is the
size of the model, never of the data. Rows are dealt to the steps of an epoch, and units are dropped, by hashes
of the row's key, so the fit does not depend on how the rows are partitioned. The loss of the held-out part is taken in the
first job of each epoch, from the weights that the epoch starts with.

Rows are stored in blocks, each as its differences from nothing or from one usual vector, whichever are fewer: rows whose
missing parts were filled with the same means differ from it in few places. Inputs are standardised on the way into the first
layer, which only multiplies the columns in which a block differs (see ``Rows``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol, Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devfold.functions import hash_bucket
from devfold.models.split import BUCKETS
from devfold.session import materialize, scratch_path

#: Rows that one task of a step reads, rows in a block or made dense at once, and sums added in one group.
TASK_ROWS, DENSE_ROWS, FAN = 4096, 512, 32
#: Fullest rows from which the usual vector is taken.
FULLEST = 15
TINY = 1e-15
HEADS = ("classes", "number")


@dataclass(frozen=True)
class Training:
    """How a network is fitted. Rates are per step, on the mean gradient of the step's rows.

    ``adaptive`` scales each weight's step by running moments of its gradient; without it the momentum grows from
    ``momentum_start`` to ``momentum_stable`` over ``momentum_ramp`` rows and the rate shrinks by ``annealing`` a row.
    Penalties act on weights, not on offsets. ``most_squared`` bounds the squared sum of the weights into a unit.
    """

    epochs: int = 500
    steps: int = 1
    activation: str = "tanh"
    hidden_dropout: float = 0.0
    input_dropout: float = 0.0
    l1: float = 0.0
    l2: float = 0.0
    rate: float = 0.01
    annealing: float = 0.0
    adaptive: bool = True
    momentum_start: float = 0.0
    momentum_stable: float = 0.0
    momentum_ramp: float = 1.0
    most_squared: float = float("inf")
    patience: int | None = 42
    tolerance: float = 0.0
    holdout: float = 0.1

    def __post_init__(self) -> None:
        if self.activation not in ("tanh", "rectifier"):
            raise ValueError(f"activation is tanh or rectifier: {self.activation}")
        if not (0 <= self.hidden_dropout < 1 and 0 <= self.input_dropout < 1):
            raise ValueError("a dropout share is at least 0 and below 1")
        if self.steps < 1 or self.epochs < 0:
            raise ValueError("steps are at least 1 and epochs at least 0")


# -- the network on one matrix ---------------------------------------------------


@dataclass(frozen=True)
class Shape:
    """Units of each layer, from the inputs to the outputs, and what the outputs are."""

    layers: tuple[int, ...]
    head: str = "classes"
    activation: str = "tanh"

    def split(self, flat: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Weights and offsets of each layer, as views of one flat array."""
        out, at = [], 0
        for wide, narrow in zip(self.layers, self.layers[1:]):
            out.append((flat[at : at + wide * narrow].reshape(wide, narrow), flat[at + wide * narrow : at + (wide + 1) * narrow]))
            at += (wide + 1) * narrow
        return out

    @property
    def size(self) -> int:
        return sum((a + 1) * b for a, b in zip(self.layers, self.layers[1:]))

    def start(self, seed: int) -> np.ndarray:
        """Uniform weights scaled by the layers' widths, offsets 0."""
        flat, rng = np.zeros(self.size), np.random.default_rng(seed)
        for weights, _ in self.split(flat):
            reach = np.sqrt(6 / sum(weights.shape))
            weights[:] = rng.uniform(-reach, reach, weights.shape)
        return flat

    def penalised(self) -> np.ndarray:
        """1 for a weight, 0 for an offset."""
        flat = np.zeros(self.size)
        for weights, _ in self.split(flat):
            weights[:] = 1
        return flat


def outputs(shape: Shape, flat: np.ndarray, x: np.ndarray, masks: Sequence[np.ndarray | None] = ()) -> list[np.ndarray]:
    """What each layer passes on; ``masks`` multiply the inputs and the hidden layers."""
    found = [x if not masks or masks[0] is None else x * masks[0]]
    layers = shape.split(flat)
    for i, (weights, offset) in enumerate(layers):
        z = found[-1] @ weights + offset
        if i + 1 == len(layers):
            if shape.head == "classes":
                z = np.exp(z - z.max(axis=1, keepdims=True))
                z /= z.sum(axis=1, keepdims=True)
        else:
            z = np.tanh(z) if shape.activation == "tanh" else np.maximum(z, 0)
            if masks and masks[i + 1] is not None:
                z = z * masks[i + 1]
        found.append(z)
    return found


def loss_of(shape: Shape, last: np.ndarray, y: np.ndarray) -> float:
    """Summed logloss of the classes, or half the summed squared error of the number."""
    if shape.head == "classes":
        return float(-np.log(np.maximum(last[np.arange(len(y)), y.astype(int)], TINY)).sum())
    return float(0.5 * ((last[:, 0] - y) ** 2).sum())


def gradient(shape: Shape, flat: np.ndarray, x: np.ndarray, y: np.ndarray, masks: Sequence[np.ndarray | None] = ()) -> tuple[np.ndarray, float]:
    """Gradient and loss, summed over the rows."""
    found, layers = outputs(shape, flat, x, masks), shape.split(flat)
    total = np.zeros_like(flat)
    parts = shape.split(total)
    error = found[-1].copy()
    if shape.head == "classes":
        error[np.arange(len(y)), y.astype(int)] -= 1
    else:
        error[:, 0] -= y
    for i in range(len(layers) - 1, -1, -1):
        parts[i][0][:] = found[i].T @ error
        parts[i][1][:] = error.sum(axis=0)
        if i:
            error = error @ layers[i][0].T
            mask = masks[i] if masks else None
            if shape.activation == "tanh":
                # dropped units passed 0 on, and what a kept one passed on carries the mask
                value = found[i] if mask is None else np.divide(found[i], mask, out=np.zeros_like(found[i]), where=mask > 0)
                error = error * (1 - value * value)
            else:
                error = error * (found[i] > 0)
            if mask is not None:
                error = error * mask
    return total, loss_of(shape, found[-1], y)


def _spread(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit values of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def dropout(shape: Shape, keys: np.ndarray, step: int, seed: int, inputs: float, hidden: float) -> list[np.ndarray | None]:
    """For the inputs and each hidden layer, 0 for a dropped unit and else what keeps the expected sum; a hash of row, unit and step decides."""
    masks: list[np.ndarray | None] = []
    for i, (width, share) in enumerate(zip(shape.layers[:-1], (inputs, *[hidden] * (len(shape.layers) - 2)), strict=True)):
        if not share:
            masks.append(None)
            continue
        unit = _spread(np.arange(width, dtype=np.uint64) + np.uint64((step * 64 + i) % 2**32) * np.uint64(2**32) + np.uint64(seed % 2**31))
        dice = _spread(keys.view(np.uint64)[:, None] ^ unit)
        masks.append((dice >= np.uint64(int(share * 2**64))) / (1 - share))
    return masks


def dense(vectors: pa.StructArray, width: int) -> np.ndarray:
    """Stored vectors, sparse or dense, as the rows of a matrix."""
    kind = vectors.field("type").to_numpy(zero_copy_only=False)
    out = np.zeros((len(vectors), width))
    for code in (0, 1):
        rows = np.flatnonzero(kind == code)
        if not len(rows):
            continue
        own = vectors.take(pa.array(rows))
        values = own.field("values")
        sizes = values.value_lengths().to_numpy()
        flat = values.flatten().to_numpy()
        at = own.field("indices").flatten().to_numpy() if code == 0 else np.tile(np.arange(width), len(rows))
        out[np.repeat(rows, sizes), at] = flat
    return out


@dataclass(frozen=True)
class Rows:
    """Standardised rows that share a base, as a matrix: ``shift`` is the standardised base, ``values`` what they add to it in the columns ``at``."""

    values: np.ndarray
    at: np.ndarray
    shift: np.ndarray

    def __matmul__(self, weights: np.ndarray) -> np.ndarray:
        return self.values @ weights[self.at] + self.shift @ weights

    def __mul__(self, mask: np.ndarray) -> np.ndarray:
        x = np.tile(self.shift, (len(self.values), 1))
        x[:, self.at] += self.values
        return x * mask

    @property
    def T(self) -> _Turned:  # noqa: N802 - as a matrix has it
        return _Turned(self)


@dataclass(frozen=True)
class _Turned:
    rows: Rows

    def __matmul__(self, error: np.ndarray) -> np.ndarray:
        out = np.outer(self.rows.shift, error.sum(axis=0))
        out[self.rows.at] += self.rows.values.T @ error
        return out


BLOCK = "usual boolean, step int, keys binary, y binary, sizes binary, at binary, place binary, differences binary"


def blocks(usual: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ``(key, y, step, x)`` as blocks of some ``DENSE_ROWS`` of one step and one base: no vector, or the usual one."""

    def block(base: bool, step: int, parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        keys, y, sizes, columns, differences = (np.concatenate(x) for x in zip(*parts))
        at, place = np.unique(columns, return_inverse=True)
        cells = [keys, y, sizes, at.astype(np.int32), place.astype(np.int32), differences]
        return pa.RecordBatch.from_arrays(
            [pa.array([base]), pa.array([step], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in cells)],
            names=["usual", "step", "keys", "y", "sizes", "at", "place", "differences"],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple[bool, int], list[tuple[np.ndarray, ...]]] = {}
        for whole in batches:
            for first in range(0, whole.num_rows, DENSE_ROWS):
                batch = whole.slice(first, DENSE_ROWS)
                keys, y, steps = (batch.column(i).to_numpy() for i in range(3))
                x = dense(batch.column(3), len(usual))
                based = (x != usual).sum(axis=1) < (x != 0).sum(axis=1)
                x[based] -= usual
                for kind in sorted(set(zip(based.tolist(), steps.tolist()))):
                    own = np.flatnonzero((based == kind[0]) & (steps == kind[1]))
                    row, column = np.nonzero(x[own])
                    parts = waiting.setdefault(kind, [])
                    parts.append((keys[own], y[own], np.bincount(row, minlength=len(own)).astype(np.int32), column, x[own][row, column]))
                    if sum(len(p[0]) for p in parts) >= DENSE_ROWS:
                        yield block(*kind, waiting.pop(kind))
        for kind, parts in waiting.items():
            yield block(*kind, parts)

    return pack


def unpacked(batch: pa.RecordBatch, i: int, usual: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> tuple[bool, np.ndarray, np.ndarray, Rows]:
    """Whether the ``i``-th block of a batch is held out, its keys, labels and standardised rows."""
    kinds = (np.int64, np.float64, np.int32, np.int32, np.int32, np.float64)
    keys, y, sizes, at, place, differences = (np.frombuffer(batch.column(2 + n)[i].as_py(), k) for n, k in enumerate(kinds))
    values = np.zeros((len(keys), len(at)))
    values[np.repeat(np.arange(len(keys)), sizes), place] = differences
    values /= scale[at]
    shift = ((usual if batch.column(0)[i].as_py() else 0.0) - centre) / scale
    return batch.column(1)[i].as_py() < 0, keys, y, Rows(values, at, shift)


# -- fitting on Spark ------------------------------------------------------------


@dataclass(frozen=True)
class Fitted:
    """Best weights, the mean and deviation each input is standardised with, and the loss of every epoch."""

    shape: Shape
    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    curve: list[tuple[int, float, float | None]]

    def table(self, spark: SparkSession) -> DataFrame:
        """``(epoch, train_loss, valid_loss)``; losses are those of the weights the epoch starts with."""
        return spark.createDataFrame(self.curve, "epoch int, train_loss double, valid_loss double")


def _tasks(rows: int) -> int:
    return max(1, -(-rows // TASK_ROWS))


def _summed(parts: DataFrame, tasks: int) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and the four figures, added up in groups of ``FAN`` until few sums are left for the driver."""

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py()) for x in table.column("sums"))
        return pa.table({"part": table.column("part").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    while tasks > FAN:
        tasks = -(-tasks // FAN)
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).groupBy("part").applyInArrow(add, "part int, sums binary")
    total = sum(np.frombuffer(row["sums"]) for row in parts.collect())
    return total[4:], total[:4]


def _step(
    table: DataFrame, shape: Shape, flat: np.ndarray, usual: np.ndarray, centre: np.ndarray, scale: np.ndarray, how: Training, step: int, seed: int, tasks: int
) -> tuple[np.ndarray, np.ndarray]:
    """Summed gradient of the training rows in the table's blocks; loss and number of training rows and of held-out rows."""
    shared = table.sparkSession.sparkContext.broadcast((flat, usual, centre, scale))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, base, mean, deviation = shared.value
        figures, total = np.zeros(4), np.zeros_like(weights)
        for batch in batches:
            for i in range(batch.num_rows):
                held, keys, y, x = unpacked(batch, i, base, mean, deviation)
                if held:
                    figures[2] += loss_of(shape, outputs(shape, weights, x)[-1], y)
                    figures[3] += len(y)
                else:
                    masks = dropout(shape, keys, step, seed, how.input_dropout, how.hidden_dropout)
                    slope, loss = gradient(shape, weights, x, y, masks)
                    total += slope
                    figures[:2] += loss, len(y)
        sums = np.concatenate([figures, total]).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([sums], pa.binary())], names=["sums"])

    parts = table.coalesce(tasks).mapInArrow(work, "sums binary").withColumn("part", F.spark_partition_id())
    try:
        return _summed(parts.select("part", "sums"), tasks)
    finally:
        shared.destroy()


class _Mover:
    """Moves the weights along a mean gradient."""

    def __init__(self, shape: Shape, how: Training) -> None:
        self.shape, self.how, self.mask = shape, how, shape.penalised()
        self.first, self.second, self.moves, self.rows = np.zeros(shape.size), np.zeros(shape.size), 0, 0.0

    def move(self, flat: np.ndarray, slope: np.ndarray, rows: float) -> np.ndarray:
        how = self.how
        slope = slope + self.mask * (how.l2 * flat + how.l1 * np.sign(flat))
        self.moves, self.rows = self.moves + 1, self.rows + rows
        if how.adaptive:
            self.first = 0.9 * self.first + 0.1 * slope
            self.second = 0.999 * self.second + 0.001 * slope * slope
            ahead = self.first / (1 - 0.9**self.moves)
            flat = flat - how.rate * ahead / (np.sqrt(self.second / (1 - 0.999**self.moves)) + 1e-8)
        else:
            share = min(1.0, self.rows / how.momentum_ramp)
            momentum = how.momentum_start + share * (how.momentum_stable - how.momentum_start)
            self.first = momentum * self.first - how.rate / (1 + how.annealing * self.rows) * slope
            flat = flat + self.first
        if np.isfinite(how.most_squared):
            for weights, _ in self.shape.split(flat):
                size = (weights * weights).sum(axis=0)
                weights *= np.sqrt(np.minimum(1, how.most_squared / np.maximum(size, TINY)))
        return flat


def usual_vector(rows: DataFrame) -> np.ndarray:
    """In each entry, what most of the ``FULLEST`` rows with the most stored entries have there.

    Only says what blocks are stored as differences from: any vector gives the same fit.
    """
    full = rows.orderBy(F.desc(F.size(F.unwrap_udt("features")["values"])), "key").limit(FULLEST).select("features").collect()
    values = np.sort(np.array([r.features.toArray() for r in full]), axis=0)
    votes = (values[:, None, :] == values[None, :, :]).sum(axis=1)
    return np.take_along_axis(values, votes.argmax(axis=0)[None], axis=0)[0]


def train(
    rows: DataFrame,
    label: str,
    key: str,
    hidden: Sequence[int],
    outputs_: int,
    head: str = "classes",
    how: Training = Training(),
    seed: int = 0,
    valid: DataFrame | None = None,
    start: np.ndarray | None = None,
) -> Fitted:
    """Fit a network on ``features`` and ``label``; ``key`` names the column that tells rows apart.

    Without ``valid`` a share of ``how.holdout`` of the rows, by a hash of the key, is held out; with a holdout of 0, or no
    patience, all epochs run on all rows and the last weights count. Else the weights of the epoch with the lowest held-out loss
    are returned, and the fit ends after ``how.patience`` epochs that bring it no lower than by ``how.tolerance`` of itself.
    ``start`` continues from given weights. Rows without a label take no part; no rows at all end the run.
    """
    if head not in HEADS:
        raise ValueError(f"head is one of {HEADS}: {head}")
    spark = rows.sparkSession
    known = rows.where(F.col(label).isNotNull())
    watching = valid is not None or (how.patience is not None and how.holdout > 0)
    step_of = F.coalesce(hash_bucket(key, how.steps, seed + 1).cast("int"), F.lit(0))
    if valid is None and watching:
        step_of = F.when(hash_bucket(key, BUCKETS, seed) < round(how.holdout * BUCKETS), F.lit(-1)).otherwise(step_of)

    def packed(df: DataFrame, step: Column) -> DataFrame:
        return df.select(F.xxhash64(key).alias("key"), F.col(label).cast("double").alias("y"), step.alias("step"), "features")

    rows = packed(known, step_of)
    if valid is not None:
        rows = rows.unionByName(packed(valid.where(F.col(label).isNotNull()), F.lit(-1)))
    rows = materialize(rows)
    sizes = {step: n for step, n in rows.groupBy("step").count().collect()}
    learning = {s: n for s, n in sizes.items() if s >= 0}
    if not learning:
        raise ValueError("no labelled row to learn from")
    stats = rows.where("step >= 0").select(Summarizer.metrics("mean", "std").summary(F.col("features")).alias("s")).select("s.mean", "s.std").head()
    usual = usual_vector(rows)
    path = scratch_path(spark, "steps")
    rows.select("key", "y", "step", F.unwrap_udt("features")).mapInArrow(blocks(usual), BLOCK).write.partitionBy("step").parquet(path)
    table = spark.read.schema(BLOCK).parquet(path).select(*[c.split()[0] for c in BLOCK.split(", ")])
    centre, spread = stats[0].toArray(), stats[1].toArray()
    scale = np.where(spread > 0, spread, 1.0)
    shape = Shape((len(centre), *hidden, outputs_), head, how.activation)
    flat = shape.start(seed) if start is None else np.array(start, float)
    mover, curve, dealt = _Mover(shape, how), [], {}
    best, lowest, waited = flat, float("inf"), 0
    watching = watching and -1 in sizes
    for epoch in range(how.epochs + 1):
        begin, told = flat, None
        for i, step in enumerate(sorted(learning)):
            if epoch == how.epochs and i:
                break
            wanted = [step, -1] if i == 0 and watching else [step]
            if i not in dealt:
                own = table.where(F.col("step").isin(wanted))
                # no more sums than files are read in, so that few tasks need no further stage to add them
                dealt[i] = own, max(1, min(_tasks(sum(sizes[s] for s in wanted)), own.rdd.getNumPartitions()))
            own, tasks = dealt[i]
            slope, (loss, n, held_loss, held) = _step(own, shape, flat, usual, centre, scale, how, epoch * len(learning) + i, seed, tasks)
            if i == 0:
                told = (epoch, float(loss / n), float(held_loss / held) if held else None)
            if epoch < how.epochs:
                flat = mover.move(flat, slope / n, n)
        curve.append(told)
        if watching:
            if told[2] < lowest - how.tolerance * abs(lowest if np.isfinite(lowest) else 0):
                best, lowest, waited = begin, told[2], 0
            else:
                waited += 1
                if how.patience is not None and waited >= how.patience:
                    break
        else:
            best = begin
    return Fitted(shape, best, centre, scale, curve)


# -- the fitted network as a stage of a pipeline -----------------------------------


class NetworkModel(Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, MLWritable, MLReadable):
    """Adds ``prediction``, and with classes ``probability``, to rows with ``features``.

    ``unit`` and ``origin`` turn the output of a number head back into the label's own unit.
    """

    head = Param(Params._dummy(), "head", "classes or number", TypeConverters.toString)
    activation = Param(Params._dummy(), "activation", "tanh or rectifier", TypeConverters.toString)
    layers = Param(Params._dummy(), "layers", "units of each layer", TypeConverters.toListInt)
    unit = Param(Params._dummy(), "unit", "scale of the number", TypeConverters.toFloat)
    origin = Param(Params._dummy(), "origin", "mean of the number", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, head: str = "classes", activation: str = "tanh", layers: list[int] | None = None, unit: float = 1.0, origin: float = 0.0, predictionCol: str = "prediction") -> None:
        super().__init__()
        self._setDefault(featuresCol="features", probabilityCol="probability")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self.numbers: dict[str, np.ndarray] = {}

    @staticmethod
    def of(found: Fitted, prediction: str = "prediction", unit: float = 1.0, origin: float = 0.0) -> NetworkModel:
        model = NetworkModel(head=found.shape.head, activation=found.shape.activation, layers=list(found.shape.layers), unit=unit, origin=origin, predictionCol=prediction)
        model.numbers = {"weights": found.weights, "centre": found.centre, "scale": found.scale}
        model.curve = found.curve
        return model

    @property
    def shape(self) -> Shape:
        return Shape(tuple(self.getOrDefault("layers")), self.getOrDefault("head"), self.getOrDefault("activation"))

    def getLayers(self) -> list[int]:
        return self.getOrDefault("layers")

    @property
    def weights(self) -> np.ndarray:
        return self.numbers["weights"]

    def _transform(self, df: DataFrame) -> DataFrame:
        shape, numbers = self.shape, self.numbers

        @F.arrow_udf("array<double>")
        def scored(vectors: pa.Array) -> pa.Array:
            parts = []
            for at in range(0, len(vectors), DENSE_ROWS):
                x = (dense(vectors.slice(at, DENSE_ROWS), len(numbers["centre"])) - numbers["centre"]) / numbers["scale"]
                parts.append(outputs(shape, numbers["weights"], x)[-1])
            last = np.concatenate([*parts, np.zeros((0, shape.layers[-1]))])
            bounds = np.arange(len(last) + 1, dtype=np.int32) * shape.layers[-1]
            return pa.ListArray.from_arrays(pa.array(bounds), pa.array(last.ravel()))

        found, out = scored(F.unwrap_udt(self.getFeaturesCol())), self.getPredictionCol()
        if shape.head == "number":
            return df.withColumn(out, F.get(found, F.lit(0)) * self.getOrDefault("unit") + self.getOrDefault("origin"))
        probability = self.getProbabilityCol()
        rated = df.withColumn(probability, found)
        best = (F.array_position(probability, F.array_max(probability)) - 1).cast("double")
        return rated.withColumn(out, best).withColumn(probability, array_to_vector(probability))

    def write(self) -> MLWriter:
        return _NetworkWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _NetworkReader()


class _NetworkWriter(MLWriter):
    def __init__(self, model: NetworkModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        rows = [(name, values.tolist()) for name, values in self.model.numbers.items()]
        self.sparkSession.createDataFrame(rows, "name string, numbers array<double>").coalesce(1).write.parquet(f"{path}/numbers")


class _NetworkReader(MLReader):
    def load(self, path: str) -> NetworkModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = NetworkModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.numbers = {name: np.array(values) for name, values in self.sparkSession.read.parquet(f"{path}/numbers").collect()}
        return model

