"""Toxicity scores by character n-grams scaled with naive Bayes log-count ratios.

Texts are lower-cased and their white space becomes one space, also in front and behind. Every run of 3, 4 or 5
characters falls by a hash into one of ``2**BITS`` buckets; a text either has a bucket or not. Counted over all labelled
rows that take part, bucket ``j`` has the ratio ``r_j = log((p_j / |p|) / (q_j / |q|))`` of toxic to other texts, counts smoothed by
``SMOOTH``. A text is the vector of the ratios of its buckets, and a logistic regression with a squared penalty weighs
them. Buckets whose ratio is within ``LEAST_Z`` standard errors of 0 are left out of the model.

Tasks count into arrays of fixed size, cells of which are summed in rounds of ``FAN`` at most. Fitting reads blocks of all
those rows in each of its steps, with the chosen buckets alone, and keeps none of them, but for rows few enough for the library; scoring is map-only with one weight for each bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devfold.llm import words as W
from devfold.llm.common import id_and_text, release, small_batches, written
from devfold.models.descent import minimised
from devfold.models.network import _summed
from devfold.models.vectors import FIELDS

SIZES = (3, 4, 5)
#: Buckets, as a power of two; buckets of one cell of counts; cells summed in one group.
BITS, CELL, FAN = 20, 1 << 12, 256
SMOOTH, LEAST_Z = 1.0, 3.0
PENALTY, ROUNDS, TOLERANCE = 1e-4, 60, 1e-6
#: Score from which a text counts as toxic.
THRESHOLD = 0.7
#: Labelled text that one task counts, buckets of texts that one task of a fitting step reads, texts in a block, and characters hashed at a time.
#: Each task of a step sends one number for every bucket with a ratio, so small tasks would send more than they read.
TASK_BYTES, STEP_CELLS, BLOCK_TEXTS, PIECE = 16 << 20, 16 << 20, 256, 1 << 19
#: Buckets of texts up to which the library fits, which holds all vectors in memory, and rows in one of its tasks.
HELD_CELLS, FIT_ROWS = 8 << 20, 1 << 14


def pieces(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Code points of consecutive texts, about ``PIECE`` at a time: number of the first text, points, and offsets of the texts."""
    held: list[str] = []
    first = size = 0
    for i, text in enumerate(texts):
        plain = f" {' '.join((text or '').lower().split())} "
        held.append(plain)
        size += len(plain)
        if size >= PIECE or i + 1 == len(texts):
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in held])])
            yield first, np.frombuffer("".join(held).encode("utf-32-le", "surrogatepass"), np.uint32), offsets
            held, first, size = [], i + 1, 0


def buckets(points: np.ndarray, offsets: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size, the bucket of every n-gram that lies within one text, and the place it starts at."""
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(points))
    codes = points * np.uint32(0x9E3779B1) ^ (points >> np.uint32(7))
    rolled, width = codes, 1
    for size in SIZES:
        while width < size:
            rolled = rolled[:-1] * np.uint32(0x01000193) + codes[width:]
            width += 1
        spread = rolled ^ np.uint32(size * 0x85EBCA6B & 0xFFFFFFFF)
        spread = (spread ^ (spread >> np.uint32(16))) * np.uint32(0x7FEB352D)
        spread = (spread ^ (spread >> np.uint32(15))) * np.uint32(0x846CA68B)
        place = np.flatnonzero(left[: len(spread)] >= size)
        yield (spread >> np.uint32(32 - bits))[place], place


def present(texts: list[str | None], bits: int, wanted: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct ``(text, bucket)`` of each piece, by text, then bucket; with ``wanted``, of the buckets it marks."""
    for first, points, offsets in pieces(texts):
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        keys = []
        for bucket, place in buckets(points, offsets, bits):
            if wanted is not None:
                hit = wanted[bucket]
                bucket, place = bucket[hit], place[hit]
            keys.append(text[place] << bits | bucket)
        found = np.concatenate(keys)
        found.sort()  # np.unique hashes all keys first, which takes ten times as long
        found = found[np.append(True, found[1:] != found[:-1])] if len(found) else found
        yield first + (found >> bits), found & ((1 << bits) - 1)


@dataclass
class Model:
    """A weight for each bucket, 0 for those left out, and the intercept."""

    weights: np.ndarray
    intercept: float

    @property
    def bits(self) -> int:
        return len(self.weights).bit_length() - 1

    def scores(self, texts: list[str | None]) -> np.ndarray:
        total = np.full(len(texts), self.intercept)
        for text, bucket in present(texts, self.bits, self.weights != 0):
            np.add.at(total, text, self.weights[bucket])
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, text, label`` of the documents with a label; of several labels of one id the largest counts.

    Labels grow with the documents, so neither side is broadcast, however small it is.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("double").alias("label"))
    return id_and_text(docs).join(known.where("label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label")).hint("merge"), "doc_id")


def bucket_counts(rows: DataFrame, bits: int = BITS) -> np.ndarray:
    """How many texts of each class have each bucket, as an array of two lines; ``rows`` has ``text`` and ``label``."""
    cell = min(CELL, 1 << bits)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(1, -(-size // TASK_BYTES))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << bits), np.int64)
        for batch in batches:
            kind = batch.column(1).to_numpy().astype(bool)
            for text, bucket in present(batch.column(0).to_pylist(), bits):
                for label in (0, 1):
                    total[label] += np.bincount(bucket[kind[text] == label], minlength=1 << bits)
        release()
        cells = total.reshape(2, -1, cell).swapaxes(0, 1)
        held = np.flatnonzero(cells.any(axis=(1, 2)))
        for at in held.tolist():
            raw = pa.array([cells[at].astype("<i8").tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), raw], names=["cell", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(raw.as_py(), "<i8") for raw in table.column("counts"))
        return pa.table({"cell": table.column("cell").slice(0, 1), "part": table.column("part").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    counted = rows.select("text", "label").coalesce(tasks).mapInArrow(count, "cell int, counts binary").withColumn("part", F.spark_partition_id())
    while True:
        counted = counted.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).groupBy("cell", "part").applyInArrow(add, "cell int, part int, counts binary")
        tasks = -(-tasks // FAN)
        if tasks == 1:
            break
    out = np.zeros((1 << bits >> cell.bit_length() - 1, 2, cell), np.int64)
    for at, _, raw in counted.toLocalIterator():
        out[at] = np.frombuffer(raw, "<i8").reshape(2, cell)
    return out.swapaxes(0, 1).reshape(2, -1)


def ratios(counts: np.ndarray, smooth: float = SMOOTH, least_z: float = LEAST_Z) -> np.ndarray:
    """Log-count ratio of each bucket; 0 where it is within ``least_z`` standard errors of 0."""
    p = counts + smooth
    ratio = np.log(p[1] / p[1].sum()) - np.log(p[0] / p[0].sum())
    return np.where(np.abs(ratio) >= least_z * np.sqrt(1 / p[0] + 1 / p[1]), ratio, 0.0)


def vectors(rows: DataFrame, ratio: np.ndarray) -> DataFrame:
    """``label, features``: the ratios of the buckets that a text has, as sparse vectors over the buckets with a ratio."""
    bits, chosen = len(ratio).bit_length() - 1, np.flatnonzero(ratio)
    slot = np.zeros(len(ratio), np.int32)
    slot[chosen] = np.arange(len(chosen))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            found = list(present(batch.column(0).to_pylist(), bits, ratio != 0))
            text, bucket = (np.concatenate([f[i] for f in found] or [np.zeros(0, np.int64)]) for i in (0, 1))
            bounds = pa.array(np.searchsorted(text, np.arange(n + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(bounds, pa.array(v)) for v in (slot[bucket], ratio[bucket])]
            kinds = (pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, len(chosen), np.int32)))
            parts = [*kinds, *(x.cast(f.type) for x, f in zip(lists, FIELDS[2:], strict=True))]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.StructArray.from_arrays(parts, fields=FIELDS)], names=["label", "features"])
            release()

    schema = T.StructType().add("label", "double").add("features", VectorUDT(), True, {"ml_attr": {"num_attrs": len(chosen)}})
    return rows.select("text", "label").mapInArrow(build, schema)


def slotted(rows: DataFrame, ratio: np.ndarray) -> DataFrame:
    """``labels, sizes, steps, far``: blocks of texts with what :func:`vectors` would have of them, without the ratios, which go by the bucket.

    A text's buckets count on from its place in the block times their number, so that they ascend in a block and are stored as
    the steps from one to the next, in 16 bits; ``far`` has where steps are longer, and by how much.
    """
    bits, chosen = len(ratio).bit_length() - 1, np.flatnonzero(ratio)
    slot = np.zeros(len(ratio), np.uint32)
    slot[chosen] = np.arange(len(chosen))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, BLOCK_TEXTS):
                batch = whole.slice(first, BLOCK_TEXTS)
                keys, sizes = [], np.zeros(batch.num_rows, np.int32)
                for text, bucket in present(batch.column(0).to_pylist(), bits, ratio != 0):
                    keys.append(text.astype(np.uint32) * np.uint32(len(chosen)) + slot[bucket])
                    sizes += np.bincount(text, minlength=batch.num_rows).astype(np.int32)
                steps = np.diff(np.concatenate(keys), prepend=np.uint32(0))
                far = np.flatnonzero(steps >> np.uint32(16))
                far = np.stack([far, steps[far] >> np.uint32(16)]).astype("<u4")
                cells = (batch.column(1).to_numpy().astype(np.int8), sizes, steps.astype("<u2"), far)
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cells], names=["labels", "sizes", "steps", "far"])
            release()

    return rows.select("text", "label").mapInArrow(build, "labels binary, sizes binary, steps binary, far binary")


def unslotted(steps: bytes, far: bytes, number: np.ndarray, width: int) -> np.ndarray:
    """Buckets of the texts of a block, which have ``number`` each, in a row."""
    found = np.frombuffer(steps, "<u2").astype(np.uint32)
    place, more = np.frombuffer(far, "<u4").reshape(2, -1)
    found[place] += more << np.uint32(16)
    return np.cumsum(found, dtype=np.uint32) - np.repeat(np.arange(len(number), dtype=np.uint32) * np.uint32(width), number)


def weighed(table: DataFrame, ratio: np.ndarray, counts: np.ndarray, sizes: tuple[float, float], penalty: float) -> tuple[np.ndarray, float]:
    """Coefficients of the buckets with a ratio, and the intercept, by a logistic regression over the blocks of :func:`slotted`.

    The regression moves on inputs of mean 0 and deviation 1, which follow from the ``counts`` of texts with each bucket; the
    penalty is on the coefficients of the ratios themselves. ``sizes`` are the numbers of texts of each class.
    """
    value, held, texts = ratio[ratio != 0], counts.sum(axis=0)[ratio != 0], float(sum(sizes))
    mean, spread = value * held / texts, np.abs(value) * np.sqrt(held * (texts - held) / (texts * max(texts - 1, 1)))
    inverse = np.divide(1.0, spread, out=np.zeros_like(spread), where=spread > 0)
    scale, centre, width = value * inverse, mean * inverse, len(value)
    tasks = max(1, min(-(-int(held.sum()) // STEP_CELLS), table.rdd.getNumPartitions()))
    context = table.sparkSession.sparkContext

    def cost(point: np.ndarray) -> tuple[float, np.ndarray]:
        weights, intercept = point[:-1], point[-1]
        shared = context.broadcast((weights * scale, float(intercept - weights @ centre)))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, offset = shared.value
            total, loss, left = np.zeros(width), 0.0, 0.0
            for batch in batches:
                for labels, number, steps, far in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                    label, number = np.frombuffer(labels, np.int8), np.frombuffer(number, np.int32)
                    slot = unslotted(steps, far, number, width)
                    margin, filled = np.full(len(label), offset), number > 0
                    if len(slot):
                        margin[filled] += np.add.reduceat(own[slot], (np.cumsum(number) - number)[filled])
                    loss += float(np.logaddexp(0, -margin).sum() + margin[label == 0].sum())
                    error = 1 / (1 + np.exp(-np.clip(margin, -500, 500))) - label
                    left += float(error.sum())
                    total += np.bincount(slot, np.repeat(error, number), width)
            sums = np.concatenate([[loss, left, 0.0, 0.0], total]).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([sums], pa.binary())], names=["sums"])

        parts = table.coalesce(tasks).mapInArrow(work, "sums binary").withColumn("part", F.spark_partition_id())
        try:
            slope, (loss, left, *_) = _summed(parts.select("part", "sums"), tasks)
        finally:
            shared.destroy()
        bound = penalty * weights * inverse * inverse
        gradient = np.append((slope * scale - left * centre) / texts + bound, left / texts)
        return float(loss / texts + 0.5 * weights @ bound), gradient

    found = minimised(cost, np.append(np.zeros(width), np.log(sizes[1] / sizes[0])), ROUNDS, TOLERANCE)
    return found[:-1] * inverse, float(found[-1] - found[:-1] @ centre)


def fit(rows: DataFrame, bits: int = BITS, smooth: float = SMOOTH, least_z: float = LEAST_Z, penalty: float = PENALTY) -> Model:
    """Learn from all ``rows`` of ``text`` and ``label`` (0 or 1); with one class alone, or no ratio that counts, the model is that of the smoothed class shares."""
    small_batches(rows.sparkSession)
    rows = written(rows.select("text", "label"))
    sizes = {label: n for label, n in rows.groupBy("label").count().collect()}
    prior = float(np.log((sizes.get(1.0, 0) + 0.5) / (sizes.get(0.0, 0) + 0.5)))
    weights = np.zeros(1 << bits)
    counts = bucket_counts(rows, bits) if len(sizes) == 2 else None
    ratio = ratios(counts, smooth, least_z) if len(sizes) == 2 else weights
    if not ratio.any():
        return Model(weights, prior)
    if counts[:, ratio != 0].sum() <= HELD_CELLS:
        learner = LogisticRegression(maxIter=ROUNDS, regParam=penalty, elasticNetParam=0.0, standardization=False, tol=TOLERANCE)
        fitted = learner.fit(written(vectors(rows, ratio)).coalesce(-(-sum(sizes.values()) // FIT_ROWS)))
        coefficients, intercept = fitted.coefficients.toArray(), float(fitted.intercept)
    else:
        coefficients, intercept = weighed(written(slotted(rows, ratio)), ratio, counts, (sizes[0.0], sizes[1.0]), penalty)
    weights[ratio != 0] = ratio[ratio != 0] * coefficients
    return Model(weights, intercept)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` of every row from its whole text alone; a null text counts as empty."""
    small_batches(docs.sparkSession)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.scores(batch.column(1).to_pylist())
            columns = [batch.column(0), pa.array(found), pa.array((found >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted"])
            release()

    return id_and_text(docs).mapInArrow(rate, "doc_id long, score double, predicted int")


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the decimal id leaves 1 modulo 3. Rows without an id are not labelled and count as not held out."""
    return F.coalesce(F.crc32(key.cast("long").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options: object) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document, by a model of the labelled rows that are not held out.

    Labels other than 0 and 1, and labels of unknown documents, are left out; of several labels of one id the largest counts.
    Documents without an id are scored, not learnt from; rows that repeat an id each take part. Null and empty texts have no
    n-gram and get the score of the intercept. Without labels of both classes every score is the smoothed
    share of toxic ones. Empty tables give no row; only the id and the text of documents are read, and the id and ``toxic`` of labels.
    """
    train = labelled(docs.where(~held_out(F.col("doc_id"))), labels)
    found = score(docs, fit(train, **options), threshold)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
