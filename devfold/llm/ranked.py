"""The best documents for each item of a query set, by matched-term masks.

The items of one block travel to the documents, never the other way. A task turns each batch of documents into
bitmaps, one for each term of the items, and groups an item's documents by mask, the set of its terms
that a document holds: bitmaps of the terms without which no document can reach the item's threshold are
united, the others are read at those documents only, and equal columns of bits make a group. No document
of a group can score more than its mask does with every term at its largest share in the batch. Groups are
scored in descending order of that bound until the bound of the next is below the lowest score of a full list: nothing that is left
can enter it. Lists live on from batch to batch, so thresholds rise as a task goes on. One list for each
task and item leaves; two levels of ranking merge them. Document frequencies come from a pass before.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from devfold.llm import words as W
from devfold.llm.common import id_and_text, release, small_batches

#: Text of the items that one pass over the documents carries.
BLOCK_BYTES = 1 << 20
#: Fixed values of the score: scale of a weight, share of the length in percent, and the factors of the saturation.
WEIGHT, LENGTH, PART, TIMES, SLOPE = 1000, 75, 1_000_000_000, 1000, 8
#: Lists that meet in one group of the first level of ranking; documents scored at a time, at first.
LISTS, CHUNK = 512, 64

#: Bytes of terms, with A-Z lower-cased: digits, letters and all beyond ASCII; others become spaces.
TERM = np.full(256, 0x20, np.uint8)
TERM[0x30:0x3A] = np.arange(0x30, 0x3A)
TERM[0x41:0x5B] = np.arange(0x61, 0x7B)
TERM[0x61:0x7B] = np.arange(0x61, 0x7B)
TERM[0x80:] = np.arange(0x80, 0x100)
FOUND = "item long, item_id long, doc_id long, score long"


def terms_of(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of every text, and the place of each text's first term."""
    data, offsets = W.buffers(texts)
    plain = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(TERM[data])])
    words = W.split(plain)
    return W.word_hashes(words), words.first


@dataclass
class Items:
    """Query items of one block: item ``i`` has the terms ``slot[first[i]:first[i + 1]]`` with their number of uses."""

    ids: list[int | None]
    vocabulary: np.ndarray
    slot: np.ndarray
    uses: np.ndarray
    first: np.ndarray

    @staticmethod
    def of(ids: list[int | None], texts: list[str | None]) -> Items:
        hashes, first = terms_of(pa.array(texts, pa.string()))
        vocabulary, slot = np.unique(hashes, return_inverse=True)
        item = np.repeat(np.arange(len(ids)), np.diff(first))
        keys, uses = np.unique(item * max(1, len(vocabulary)) + slot, return_counts=True)
        owner, slot = np.divmod(keys, max(1, len(vocabulary)))
        return Items(ids, vocabulary, slot, uses, np.searchsorted(owner, np.arange(len(ids) + 1)))

    def postings(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ascending ``slot * rows + row`` of each term of the items in each text, its uses there, and the terms of each text."""
        hashes, first = terms_of(texts)
        if not len(self.vocabulary):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.diff(first)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        hit = np.flatnonzero(self.vocabulary[at] == hashes)
        row = np.searchsorted(first, hit, "right") - 1
        keys, uses = np.unique(at[hit] * (len(first) - 1) + row, return_counts=True)
        return keys, uses, np.diff(first)


@dataclass
class Corpus:
    """Documents with a term, all their terms, and the weight of each term of a block."""

    documents: int
    terms: int
    weight: np.ndarray

    def parts(self, uses: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Saturated share of a term used so often in texts of so many terms."""
        slope = 100 - LENGTH + (LENGTH * lengths * self.documents) // self.terms
        return (PART * uses) // (TIMES * uses + SLOPE * slope)


def statistics(docs: DataFrame, items: Items) -> Corpus:
    """Counts over all documents; each task sends one row for every term it met."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(items.vocabulary) + 2, np.int64)
        for batch in batches:
            keys, _, lengths = items.postings(batch.column(1))
            total[:-2] += np.bincount(keys // max(1, batch.num_rows), minlength=len(total) - 2)
            total[-2:] += (lengths > 0).sum(), lengths.sum()
        release()
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["slot", "n"])

    total = np.zeros(len(items.vocabulary) + 2, np.int64)
    for slot, n in docs.mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n")).toLocalIterator():
        total[slot] = n
    documents, terms = int(total[-2]), int(total[-1])
    weight = [math.floor(WEIGHT * math.log((2 * documents + 2) / (2 * df + 1))) for df in total[:-2].tolist()]
    return Corpus(documents, terms, np.array(weight, np.int64))


class Lists:
    """The best rows of each item so far: descending score, then ascending id, null ids last."""

    def __init__(self, items: int, top: int) -> None:
        self.top = top
        self.rows = [np.zeros((0, 3), np.int64)] * items  # score, whether the id is null, id
        self.least = np.ones(items, np.int64)  # a row below this cannot enter

    def add(self, item: int, score: np.ndarray, missing: np.ndarray, ids: np.ndarray) -> None:
        rows = np.concatenate([self.rows[item], np.stack([score, missing, ids], 1)[score >= self.least[item]]])
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], -rows[:, 0]))][: self.top]
        self.rows[item] = rows
        if len(rows) == self.top:
            self.least[item] = max(1, int(rows[-1, 0]))


class Batch:
    """Bitmaps and shares of the terms in one batch of documents."""

    def __init__(self, items: Items, corpus: Corpus, batch: pa.RecordBatch) -> None:
        self.items, self.rows = items, batch.num_rows
        keys, uses, lengths = items.postings(batch.column(1))
        slot, row = np.divmod(keys, self.rows)
        self.keys = keys
        self.share = corpus.weight[slot] * corpus.parts(uses, lengths[row])
        self.missing = batch.column(0).is_null().to_numpy(zero_copy_only=False).astype(np.int64)
        self.ids = batch.column(0).fill_null(0).to_numpy()
        #: largest share of each term
        self.most = np.zeros(len(items.vocabulary), np.int64)
        held = np.flatnonzero(np.diff(slot, prepend=-1))
        if len(held):
            self.most[slot[held]] = np.maximum.reduceat(self.share, held)
        #: one bit for each row, one line for each term that is there
        self.line = np.full(len(items.vocabulary), -1)
        self.line[slot[held]] = np.arange(len(held))
        self.bits = np.zeros((len(held), -(-self.rows // 8)), np.uint8)
        cell = self.line[slot] * self.bits.shape[1] + (row >> 3)
        begin = np.flatnonzero(np.diff(cell, prepend=-1))
        if len(begin):
            self.bits.ravel()[cell[begin]] = np.add.reduceat((128 >> (row & 7)).astype(np.uint8), begin)

    def search(self, lists: Lists) -> None:
        """Bring the lists of all items up to date."""
        bound = self.items.uses * self.most[self.items.slot]
        total = np.concatenate([[0], np.cumsum(bound)])
        total = total[self.items.first[1:]] - total[self.items.first[:-1]]
        for item in np.flatnonzero(total >= lists.least).tolist():
            self.search_one(item, bound, lists)

    def search_one(self, item: int, bound: np.ndarray, lists: Lists) -> None:
        own = slice(self.items.first[item], self.items.first[item + 1])
        bound, slot, uses = bound[own], self.items.slot[own], self.items.uses[own]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        bound, slot, uses = bound[order], slot[order], uses[order]
        # a document with none of the first terms has the others at most, which is below the threshold
        rest = np.cumsum(bound[::-1])[::-1]
        needed = int(np.searchsorted(-rest, -lists.least[item], "right"))
        bits = self.bits[self.line[slot]]
        rows = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(bits[:needed]), count=self.rows))
        masks = np.packbits(bits[:, rows >> 3] >> (7 - (rows & 7)).astype(np.uint8) & 1, axis=0).T
        group, which = np.unique(np.ascontiguousarray(masks).view(f"V{masks.shape[1]}").ravel(), return_inverse=True)
        held = np.unpackbits(group.view(np.uint8).reshape(len(group), -1), axis=1, count=len(slot))
        most = held.astype(np.int64) @ bound
        by_mask = np.argsort(which, kind="stable")
        ends = np.cumsum(np.bincount(which, minlength=len(group)))
        best = np.argsort(-most, kind="stable")
        at, size = 0, CHUNK
        while at < len(best) and most[best[at]] >= lists.least[item]:
            sizes = np.cumsum((ends - np.concatenate([[0], ends[:-1]]))[best[at:]])
            stop = at + 1 + int(np.searchsorted(sizes, size))
            taken = best[at:stop][most[best[at:stop]] >= lists.least[item]]
            member = by_mask[W.runs(np.concatenate([[0], ends[:-1]])[taken], np.bincount(which, minlength=len(group))[taken])]
            found = rows[member]
            lists.add(item, self.scores(slot, uses, found), self.missing[found], self.ids[found])
            at, size = stop, 2 * size

    def scores(self, slot: np.ndarray, uses: np.ndarray, rows: np.ndarray) -> np.ndarray:
        keys = slot[:, None] * self.rows + rows
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return (np.where(self.keys[at] == keys, self.share[at], 0) * uses[:, None]).sum(0)


def blocks(items: DataFrame, block_bytes: int) -> Iterator[Items]:
    """The items as blocks of about ``block_bytes`` of text each; rows alike in id and text are one item."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // block_bytes))
    for block in range(count):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block).orderBy("item_id", "text").collect()
        if own:
            yield Items.of([r[0] for r in own], [r[1] for r in own])


def ranked(docs: DataFrame, items: DataFrame, top: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item with a score above 0.

    Equal scores go by ascending id, null ids last; rows that repeat an id are ranked one by one. Null
    and empty texts hold no term: as documents they count nowhere, as items they give no row. Items alike in id and text are one;
    several texts under one id are ranked each for itself. Empty tables give no row; other columns than the
    id and the text are not read. Terms are told apart by 64-bit hashes. 64-bit numbers hold as long as 75 times
    the documents times the terms of the longest one does.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = id_and_text(docs)

    def searcher(block: Items, corpus: Corpus, origin: int):
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lists = Lists(len(block.ids), top)
            for batch in batches:
                if batch.num_rows:
                    Batch(block, corpus, batch).search(lists)
            release()
            own = np.repeat(np.arange(len(block.ids)), [len(r) for r in lists.rows])
            found = np.concatenate(lists.rows)
            columns = [pa.array(origin + own), pa.array(block.ids, pa.int64()).take(pa.array(own)), pa.array(found[:, 2], mask=found[:, 1] > 0), pa.array(found[:, 0])]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "item_id", "doc_id", "score"])

        return search

    passes, origin = [], 0
    for block in blocks(items, block_bytes):
        corpus = statistics(rows, block)
        if corpus.documents:
            passes.append(rows.mapInArrow(searcher(block, corpus, origin), FOUND))
        origin += len(block.ids)
    if not passes:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = reduce(DataFrame.unionByName, passes).withColumn("part", F.floor(F.spark_partition_id() / LISTS))
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    part = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("rank") <= top)
    best = part.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
    return best.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
