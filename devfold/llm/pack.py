"""Packing by the length histogram, shortest pack first.

Documents become token ids with an end id and are cut into pieces of at most
``capacity``. Only the histogram of piece lengths (``capacity`` rows at most) reaches
the driver. There lengths are placed longest first, each into the pack with the most
room left; packs that look alike are one pattern with a count, so the work depends on
the number of lengths, not of documents. Each pattern then owns a range of ranks of
every length it uses, and a piece finds its place by its rank among the pieces of its
length. Ranks come from counts over hashed buckets, so a length that a third of all
pieces share is ranked by many tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from devfold.llm import encode
from devfold.llm.common import BATCH_BYTES, id_and_text, release, small_batches, written

CAPACITY = 4096
END_ID = 2
#: Pieces ranked in one task, about.
RANKED = 20_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Every document's ids in pieces of at most ``capacity``, with the crc32 of each piece.

    A null or empty text is the end id alone. Null and repeated ids stay as they are:
    each row is a document of its own. Only ``doc_id`` and ``text`` are read.
    """
    path = vocabulary or encode.vocabulary()
    small_batches(docs.sparkSession, batch_bytes)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encode.encoder(path)
        for batch in batches:
            ids, bounds = encode.with_end(*encoder.encode(batch.column(1)), end_id)
            ids = ids.astype("<u4")
            size = np.diff(bounds)
            each = -(-size // capacity)
            doc = np.repeat(np.arange(len(size)), each)
            ends = np.cumsum(each)
            start = (np.arange(int(each.sum())) - np.repeat(ends - each, each)) * capacity
            length = np.minimum(size[doc] - start, capacity)
            raw, at = memoryview(ids).cast("B"), (bounds[doc] + start) * 4
            crc = [zlib.crc32(raw[a : a + n]) for a, n in zip(at.tolist(), (length * 4).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc)), *(pa.array(x, pa.int64()) for x in (start, length, crc, size[doc]))],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )
            release()
        encoder.forget()  # the worker goes on to other stages and must not take the table along
        release()

    return id_and_text(docs).mapInArrow(cut, PIECES)


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns with counts: a pattern lists (length, times) in the order of placement."""
    open_packs: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}

    def keep(pattern: list[tuple[int, int]], count: int, room: int) -> None:
        open_packs.setdefault(room, []).append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max(open_packs, default=0)
            if room < length:
                times = capacity // length
                whole, rest = divmod(left, times)
                if whole:
                    keep([(length, times)], whole, capacity - times * length)
                if rest:
                    keep([(length, rest)], 1, capacity - rest * length)
                break
            pattern, count = open_packs[room].pop()
            used = min(count, left)
            if used < count:
                open_packs[room].append((pattern, count - used))
            elif not open_packs[room]:
                del open_packs[room]
            same = pattern[-1][0] == length
            keep([*pattern[: len(pattern) - same], (length, pattern[-1][1] * same + 1)], used, room - length)
            left -= used
    return [x for group in open_packs.values() for x in group]


def places(patterns: list[tuple[list[tuple[int, int]], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, times, offset), ordered by length and rank."""
    rows, taken, sequence = [], {}, 0
    for pattern, count in patterns:
        offset = 0
        for length, times in pattern:
            rank = taken.get(length, 0)
            rows.append((length, rank, sequence, times, offset))
            taken[length] = rank + count * times
            offset += length * times
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def ranked(parts: DataFrame, total: int) -> DataFrame:
    """Rank of each piece among those of its length, from 0; only rows alike in every column tie."""
    buckets = max(16, total // RANKED)
    keyed = parts.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    sizes = keyed.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "start", "ids_crc32")
    numbered = keyed.withColumn("_at", F.row_number().over(inside) - 1)
    return numbered.join(sizes, ["length", "_bucket"]).withColumn("_rank", F.col("_at") + F.col("_base"))


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Place of every piece: ``sequence_id`` and ``offset`` beside the columns of :func:`pieces`.

    Sequences are gapless from offset 0. An empty table gives no row.
    """
    parts = written(pieces(docs, vocabulary, capacity, end_id, batch_bytes))
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = places(shortest_pack_first(histogram, capacity))
    length, first, sequence, times, offset = table.T.copy()
    shift = 2**40
    if len(table) and first.max() >= shift:
        raise ValueError("more pieces of one length than ranks can number")
    starts = length * shift + first

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            long, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            row = np.searchsorted(starts, long * shift + rank, "right") - 1
            nth = rank - first[row]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")), pa.array(sequence[row] + nth // times[row]), pa.array(offset[row] + nth % times[row] * long)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "_rank"]
    return ranked(parts, sum(histogram.values())).select(*columns).mapInArrow(put, PIECES + ", sequence_id long, offset long")
