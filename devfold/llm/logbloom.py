"""Language-model scoring from a log-frequency Bloom filter.

N-gram counts of the training documents are gathered per batch, summed in hash buckets and
quantised on a log scale: a count of level ``q`` enters the filter as ``(n-gram, 1) ... (n-gram, q)``.
Each bucket makes its own slice of the filter, so building is spread and the whole is as
large as the corpus asks for. A worker reads a level by probing 1, 2, ... until a probe
fails; the level's mean count then enters a smoothed probability, in which the weight of a history follows how often its
like were seen to recur. The filter is broadcast in
blocks of bounded size; with more than one block the texts are passed over once for each,
carrying the levels found so far, with the same scores.

The base score needs exact unigram counts, which grow with the corpus and are never
broadcast: ranges of documents send their distinct words to the buckets and get the counts back.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devfold.llm import words as W
from devfold.llm.common import group_of, id_and_text, ranges_of, release, small_batches, written
from devfold.llm.jaccard import bucketed
from devfold.llm.repair import _order
from devfold.llm.substrings import squeeze, unsqueeze

#: N-gram order, base of the log quantisation, hash functions, bits for each entry.
ORDER, LOG_BASE, HASHES, ENTRY_BITS = 2, 2.0, 3, 8
#: Bytes of filter that one pass broadcasts.
BLOCK_BYTES = 128 << 20
BUCKET_ROWS, RANGE_BYTES = 1_000_000, 4 << 20
#: Key of the end token, which is no word's hash by construction of the mixing.
END = np.uint64(0x0123456789ABCDEF)
MOST_LEVELS = 64


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every text's words, A-Z lower-cased, each text closed by the end token; and bounds."""
    words = W.split(texts, lower=True)
    bounds = words.first + np.arange(len(words.first))
    out = np.full(int(bounds[-1]), END, np.uint64)
    out[W.runs(bounds[:-1], words.counts)] = W.word_hashes(words)
    return out, bounds


def grams(keys: np.ndarray, bounds: np.ndarray, order: int) -> np.ndarray:
    """Key of the n-gram that ends at each token, for orders 1 to ``order`` (one row each).

    Before a text's first token stands the end token, as often as needed.
    """
    rows = [W.mix(keys + np.uint64(1))]
    place = np.arange(len(keys)) - np.repeat(bounds[:-1], np.diff(bounds))
    sums = keys.copy()
    for n in range(2, order + 1):
        shifted = np.full(len(keys), END, np.uint64)
        inside = place >= n - 1
        shifted[inside] = keys[np.flatnonzero(inside) - (n - 1)]
        sums = sums + W.mix(shifted + np.uint64(n * 0x9E3779B9))
        rows.append(W.mix(sums + np.uint64(n)))
    return np.stack(rows)


def contexts(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Position of the token before each token; -1 before a text's first."""
    at = np.arange(len(keys)) - 1
    at[bounds[:-1][np.diff(bounds) > 0]] = -1
    return at


@dataclass
class Filter:
    """Slices of the filter in bucket order: slice ``b`` has ``size[b]`` bits from ``start[b]`` on."""

    buckets: int
    start: np.ndarray
    size: np.ndarray
    bits: np.ndarray
    low: int

    def levels(self, keys: np.ndarray, known: np.ndarray | None = None) -> np.ndarray:
        """Highest level whose probes, and those of all lower levels, succeed; keys of other blocks keep ``known``."""
        out = np.zeros(len(keys), np.uint8) if known is None else known.copy()
        bucket = ((keys >> np.uint64(32)) * np.uint64(self.buckets) >> np.uint64(32)).astype(np.int64) - self.low
        live = np.flatnonzero((bucket >= 0) & (bucket < len(self.size)))
        live = live[self.size[bucket[live]] > 0]
        for level in range(1, MOST_LEVELS):
            if not len(live):
                break
            own = bucket[live]
            hit = np.ones(len(live), bool)
            for place in positions(keys[live], level, self.size[own]):
                at = self.start[own] + place
                hit &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            live = live[hit]
            out[live] = level
        return out


def positions(keys: np.ndarray, level: int, size: np.ndarray) -> Iterator[np.ndarray]:
    """Bit of each hash function for ``(key, level)`` within slices of ``size`` bits."""
    one = W.mix(keys ^ np.uint64(level * 0x9E3779B97F4A7C15 % 2**64))
    two = W.mix(one) | np.uint64(1)
    for i in range(HASHES):
        yield ((one + np.uint64(i) * two) % size.astype(np.uint64)).astype(np.int64)


def quantise(counts: np.ndarray) -> np.ndarray:
    """Level of a count: 1 for one, one more for each factor of the log base."""
    return np.minimum(1 + np.floor(np.log(counts) / math.log(LOG_BASE) + 1e-9), MOST_LEVELS - 1).astype(np.int64)


@dataclass
class Model:
    """What scoring needs beside the filter.

    ``means`` has the mean count of each order and level, ``trust`` the weight of a higher
    order by the level of its history: the share of training tokens after such histories
    whose n-gram is no singleton (what Good and Turing expect to be seen again).
    """

    train_tokens: int
    types: int
    means: np.ndarray
    trust: np.ndarray
    start_level: int

    def score(self, levels: np.ndarray, before: np.ndarray) -> np.ndarray:
        """log10 probability of each token from the levels of its n-grams (orders by tokens)."""
        p = (self.means[0][levels[0]] + 0.5) / (self.train_tokens + 0.5 * (self.types + 1))
        for n in range(1, len(levels)):
            past = history(levels, before, n, self.start_level)
            count = self.means[n][levels[n]]
            seen = np.maximum(self.means[n - 1][past], count)  # a history is at least as frequent as what it starts
            weight = np.where(past > 0, self.trust[n][past], 0.0)
            p = weight * count / np.maximum(seen, 1) + (1 - weight) * p
        return np.log10(p)


def history(levels: np.ndarray, before: np.ndarray, n: int, start_level: int) -> np.ndarray:
    """Level of the history of each token's n-gram of order ``n + 1``; a text starts after an end token."""
    return np.where(before >= 0, levels[n - 1][before], start_level)


def gather(train: DataFrame, order: int, size: int) -> tuple[DataFrame, int]:
    """Slices of the filter: one row for each bucket, with level statistics."""
    buckets = max(12, size // 6 * order // BUCKET_ROWS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, bounds = tokens(batch.column(0))
            out: list[list] = [[], [], [], []]
            for n, row in enumerate(grams(keys, bounds, order)):
                distinct, times = np.unique(row, return_counts=True)
                _, at = bucketed(distinct, buckets)
                for b in np.flatnonzero(np.diff(at)).tolist():
                    part = slice(at[b], at[b + 1])
                    for column, value in zip(out, (b, n, squeeze(distinct[part]), times[part].astype("<u4").tobytes()), strict=True):
                        column.append(value)
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds, strict=True)], names=["bucket", "n", "keys", "counts"])
            release()

    def build(key: tuple, table: pa.Table) -> pa.Table:
        numbers = table.column("n").to_numpy()
        stats = np.zeros((order, MOST_LEVELS, 2))
        entered = []
        for n in range(order):
            own = table.filter(pa.array(numbers == n))
            if not own.num_rows:
                continue
            keys = np.concatenate([unsqueeze(x) for x in own.column("keys").to_pylist()])
            times = np.concatenate([np.frombuffer(x, "<u4") for x in own.column("counts").to_pylist()])
            distinct, which = np.unique(keys, return_inverse=True)
            sums = np.bincount(which, times, len(distinct))
            level = quantise(sums)
            stats[n, :, 0] = np.bincount(level, minlength=MOST_LEVELS)
            stats[n, :, 1] = np.bincount(level, sums, MOST_LEVELS)
            entered.append((distinct, level))
        entries = int(sum(level.sum() for _, level in entered))
        bits = -(-entries * ENTRY_BITS // 64) * 64
        plane = np.zeros(bits, bool)
        for keys, level in entered:
            for q in range(1, int(level.max()) + 1):
                inside = keys[level >= q]
                for place in positions(inside, q, np.full(len(inside), bits)):
                    plane[place] = True
        packed = np.packbits(plane, bitorder="little").tobytes()
        release()
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "size": pa.array([bits], pa.int64()), "bits": pa.array([packed], pa.binary()), "stats": pa.array([stats.tobytes()], pa.binary())})

    cells = train.mapInArrow(count, "bucket int, n int, keys binary, counts binary")
    return cells.groupBy("bucket").applyInArrow(build, "bucket int, size long, bits binary, stats binary"), buckets


def blocks(slices: DataFrame, buckets: int, block_bytes: int) -> Iterator[Filter]:
    """The filter in bucket ranges of at most ``block_bytes`` (one slice at least)."""
    sizes = np.zeros(buckets, np.int64)
    for row in slices.select("bucket", "size").collect():
        sizes[row["bucket"]] = row["size"]
    low = 0
    while low < buckets:
        high = low + 1
        while high < buckets and sizes[low : high + 1].sum() <= 8 * block_bytes:
            high += 1
        rows = slices.where(F.col("bucket").between(low, high - 1)).orderBy("bucket").select("bits").toLocalIterator()
        bits = np.frombuffer(b"".join(bytes(r["bits"]) for r in rows), np.uint8)
        size = sizes[low:high]
        yield Filter(buckets, np.cumsum(size) - size, size, bits, low)
        low = high


def score_texts(
    docs: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Training rows are those whose crc32 of the id's text leaves no remainder 1 by 5; a null
    id counts as empty text, so it trains. Null and empty texts are the end token alone. With
    no training row all counts are 0. Only ``doc_id`` and ``text`` are read; an empty table
    gives no row. Tokens are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = id_and_text(docs).withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1)
    cuts, size = ranges_of(rows, range_bytes)
    made, buckets = gather(rows.where("NOT held_out").select("text"), order, size)
    slices = written(made)
    stats = np.zeros((order, MOST_LEVELS, 2))
    for row in slices.select("stats").toLocalIterator():
        stats += np.frombuffer(bytes(row["stats"])).reshape(stats.shape)
    means = stats[:, :, 1] / np.maximum(stats[:, :, 0], 1)
    train_tokens, types = int(stats[0, :, 1].sum()), int(stats[0, :, 0].sum())
    whole = slices.agg(F.sum("size")).first()[0] or 0
    single = whole <= 8 * block_bytes

    def probed(batch_keys: np.ndarray, bounds: np.ndarray, known: bytes | None, part: Broadcast) -> np.ndarray:
        keys = grams(batch_keys, bounds, order).ravel()
        distinct, back = np.unique(keys, return_inverse=True)
        first = np.zeros(len(distinct), np.int64)
        first[back] = np.arange(len(keys))
        levels = np.frombuffer(known, np.uint8)[first] if known else np.zeros(len(distinct), np.uint8)
        return part.value.levels(distinct, levels)[back]

    # exact unigram counts travel by range
    ranged = rows.withColumn("range", group_of(cuts))
    word_buckets = max(12, size // 40 // BUCKET_ROWS)

    def send(key: tuple, table: pa.Table) -> pa.Table:
        keys, bounds = tokens(table.column("text"))
        trains = np.repeat(~table.column("held_out").to_numpy(), np.diff(bounds))
        distinct, back = np.unique(keys, return_inverse=True)
        times = np.bincount(back, trains, len(distinct))
        _, at = bucketed(distinct, word_buckets)
        held = np.flatnonzero(np.diff(at))
        cells = [squeeze(distinct[at[b] : at[b + 1]]) for b in held]
        sums = [times[at[b] : at[b + 1]].astype("<u4").tobytes() for b in held]
        release()
        return pa.table({"range": pa.array(np.full(len(held), key[0].as_py()), pa.int32()), "bucket": pa.array(held, pa.int32()), "keys": pa.array(cells, pa.binary()), "counts": pa.array(sums, pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        each = [unsqueeze(x) for x in table.column("keys").to_pylist()]
        times = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("counts").to_pylist()])
        distinct, back = np.unique(np.concatenate(each), return_inverse=True)
        sums = np.bincount(back, times, len(distinct)).astype("<u8")[back]
        ends = np.cumsum([len(x) for x in each])
        cells = [x.tobytes() for x in np.split(sums, ends[:-1])]
        return pa.table({"range": table.column("range"), "bucket": table.column("bucket"), "keys": table.column("keys"), "counts": pa.array(cells, pa.binary())})

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.take(_order(left))
        keys, bounds = tokens(left.column("text"))
        right = right.sort_by("bucket")
        known = np.concatenate([unsqueeze(x) for x in right.column("keys").to_pylist()])
        times = np.concatenate([np.frombuffer(x, "<u8") for x in right.column("counts").to_pylist()])
        count = times[np.searchsorted(known, keys)]
        logs = np.log10((count + 0.5) / (train_tokens + 0.5 * (types + 1)))
        n = left.num_rows
        release()
        base = [math.fsum(logs[a:b].tolist()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        seen = np.concatenate([[0], np.cumsum(count > 0)])
        sums = np.concatenate([[0.0], np.cumsum(model.score(levels_of(left, keys, bounds), contexts(keys, bounds)))])
        value = sums[bounds[1:]] - sums[bounds[:-1]]
        return pa.table(
            {
                "doc_id": left.column("doc_id"),
                "held_out": left.column("held_out"),
                "n_tokens": pa.array(np.diff(bounds), pa.int64()),
                "n_known": pa.array(seen[bounds[1:]] - seen[bounds[:-1]], pa.int64()),
                "train_tokens": pa.array(np.full(n, train_tokens), pa.int64()),
                "base_score": pa.array(base, pa.float64()),
                "score": pa.array(value, pa.float64()),
            }
        )

    def step(part: Broadcast):
        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys, bounds = tokens(batch.column("text"))
                cells = batch.column("levels").to_pylist()
                known = None if None in cells else _together(b"".join(cells), bounds, order).tobytes()
                levels = probed(keys, bounds, known, part).reshape(order, -1)
                cells = [np.ascontiguousarray(levels[:, a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(cells, pa.binary())], names=batch.schema.names)

        return look

    def levels_of(table: pa.Table | pa.RecordBatch, keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        if single:
            return probed(keys, bounds, None, part).reshape(order, -1)
        return _together(b"".join(table.column("levels").to_pylist()), bounds, order).reshape(order, -1)

    def recur(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, order, MOST_LEVELS), np.int64)
        for batch in batches:
            keys, bounds = tokens(batch.column("text"))
            levels, before = levels_of(batch, keys, bounds), contexts(keys, bounds)
            for n in range(1, order):
                past = history(levels, before, n, start_level)
                sums[0, n] += np.bincount(past, minlength=MOST_LEVELS)
                sums[1, n] += np.bincount(past, levels[n] == 1, MOST_LEVELS).astype(np.int64)
            release()
        n, level = np.nonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(n, pa.int32()), pa.array(level, pa.int32()), pa.array(sums[0][n, level]), pa.array(sums[1][n, level])], names=["n", "level", "tokens", "single"])

    sent = ranged.groupBy("range").applyInArrow(send, "range int, bucket int, keys binary, counts binary")
    answers = sent.groupBy("bucket").applyInArrow(add, "range int, bucket int, keys binary, counts binary")
    texts, part, start_level = ranged, None, 0
    if not single:
        texts = texts.withColumn("levels", F.lit(None).cast("binary"))
    end_key = grams(np.array([END]), np.array([0, 1]), 1)[0]
    for block in blocks(slices, buckets, block_bytes):
        start_level = max(start_level, int(block.levels(end_key)[0]))
        part = spark.sparkContext.broadcast(block)
        if not single:  # one block in memory at a time
            texts = written(texts.mapInArrow(step(part), texts.schema))
            part.unpersist()
    trust = np.zeros((order, MOST_LEVELS))
    seen = texts.where("NOT held_out").drop("range").mapInArrow(recur, "n int, level int, tokens long, single long")
    for row in seen.groupBy("n", "level").agg(F.sum("tokens").alias("tokens"), F.sum("single").alias("single")).collect():
        trust[row["n"], row["level"]] = 1 - row["single"] / row["tokens"]
    model = Model(train_tokens, types, means, trust, start_level)
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return texts.groupBy("range").cogroup(answers.groupBy("range")).applyInArrow(score, out)


def _together(raw: bytes, bounds: np.ndarray, order: int) -> np.ndarray:
    """Levels stored text by text (orders by tokens each) as orders by all tokens, flat."""
    flat = np.frombuffer(raw, np.uint8)
    size = np.diff(bounds)
    out = np.empty((order, int(bounds[-1])), np.uint8)
    for n in range(order):
        out[n] = flat[W.runs(bounds[:-1] * order + n * size, size)]
    return out.ravel()
