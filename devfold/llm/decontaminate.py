"""Short test items found inside documents of any length, by size-partitioned MinHash containment.

Items are partitioned by the size of their shingle set. Each partition keeps, for every item,
as many minima of a random order as leave no item unseen: an item contained to 80 percent
lacks at most a fifth of its shingles, so one more minimum than that is always hit (beyond
``MOST_MINIMA`` the chance of a miss is below ``0.2**MOST_MINIMA``). A document searches only the
partitions whose smallest item it could contain, and the length of the document does not
dilute the search, as minima of the small set are looked up in the large one. Candidates
are then verified by exact containment of the item's shingles. Map-only over the documents.

Items reach the workers in blocks of bounded size; more items make more blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devfold.llm import words as W
from devfold.llm.common import STAGE_BATCH_BYTES, release, small_batches
from devfold.llm.jaccard import shingle_sets

WIDTH, SHARE = 5, 80
MOST_MINIMA = 32
#: Text of the items that one pass over the documents carries.
BLOCK_BYTES = 8 << 20
OUT = "doc_id long, item_id long, n_item long, n_shared long, containment double"


@dataclass
class Part:
    """Items of one size class: minima in ascending order, the item of each, and the smallest overlap needed."""

    minima: np.ndarray
    owner: np.ndarray
    least: int


class Index:
    """Searchable items of one block."""

    def __init__(self, ids: list[int | None], texts: list[str | None], width: int, share: int) -> None:
        self.ids, self.width, self.share = ids, width, share
        column = pa.array(texts, pa.string())
        self.sets: list[np.ndarray] = []
        keys, bounds = shingle_sets(column, width)
        self.sets = [keys[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        words = W.split(column).counts
        #: An item of fewer words than a shingle is one run of that many words.
        self.width_of = np.minimum(np.maximum(words, 1), width)
        self.parts: dict[tuple[int, int], Part] = {}
        groups: dict[tuple[int, int], list[int]] = {}
        for i, own in enumerate(self.sets):
            if len(own):
                groups.setdefault((int(self.width_of[i]), len(own).bit_length()), []).append(i)
        for key, members in groups.items():
            minima, owner, least = [], [], 1 << 60
            for i in members:
                size = len(self.sets[i])
                need = -(-share * size // 100)
                spread = W.mix(self.sets[i])
                kept = np.sort(spread)[: min(size - need + 1, MOST_MINIMA)]
                minima.append(kept)
                owner.append(np.full(len(kept), i))
                least = min(least, need)
            flat, who = np.concatenate(minima), np.concatenate(owner)
            order = np.argsort(flat, kind="stable")
            self.parts[key] = Part(flat[order], who[order], least)

    def search(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, item and shared shingles of every item that a text contains."""
        words = W.split(texts, lower=True)
        hashes = W.word_hashes(words)
        found: list[tuple[int, int, int]] = []
        for width in sorted({w for w, _ in self.parts}):
            keys, start = W.windows(hashes, words.first, width)
            if width < self.width:
                keys = _short(hashes, start, width)
            if not len(keys):
                continue
            spread = W.mix(keys)
            text = np.searchsorted(words.first, start, "right") - 1
            sizes = np.bincount(text, minlength=len(words.first) - 1)
            pairs = [np.zeros((0, 2), np.int64)]
            for (own, _), part in self.parts.items():
                if own != width:
                    continue
                fits = sizes[text] >= part.least
                low = np.searchsorted(part.minima, spread)
                hit = np.flatnonzero(fits & (low < len(part.minima)))
                hit = hit[part.minima[low[hit]] == spread[hit]]
                high = np.searchsorted(part.minima, spread[hit], "right")
                each = high - low[hit]
                pairs.append(np.stack([np.repeat(text[hit], each), part.owner[W.runs(low[hit], each)]], 1))
            bounds = np.searchsorted(text, np.arange(len(words.first)))
            last, whole = -1, keys[:0]
            for doc, item in np.unique(np.concatenate(pairs), axis=0).tolist():
                if doc != last:
                    last, whole = doc, np.unique(keys[bounds[doc] : bounds[doc + 1]])
                own_set = self.sets[item]
                at = np.minimum(np.searchsorted(whole, own_set), len(whole) - 1)
                shared = int((whole[at] == own_set).sum())
                if 100 * shared >= self.share * len(own_set):
                    found.append((doc, item, shared))
        out = np.array(found, np.int64).reshape(-1, 3)
        return out[:, 0], out[:, 1], out[:, 2]


def _short(hashes: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """Keys of runs of ``size`` words as ``shingle_sets`` gives them to texts of that many words."""
    whole = hashes[start[:, None] + np.arange(size)]
    return W.mix((whole * W.powers(W.WORD_BASE, size)[0][:size]).sum(1) + np.uint64(size))


def blocks(items: DataFrame, width: int, share: int, block_bytes: int) -> Iterator[Index]:
    """The items as indexes of about ``block_bytes`` of text each."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // block_bytes))
    for block in range(count):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block).orderBy("item_id", "text").collect()
        if own:
            yield Index([r[0] for r in own], [r[1] for r in own], width, share)


def contained(docs: DataFrame, items: DataFrame, width: int = WIDTH, share: int = SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each item that a document contains: ids, set size, shared shingles, containment.

    Words are compared with A-Z lower-cased. Containment is over the whole document and
    counts where ``100 * shared >= share * n_item``. An item of fewer words than a shingle
    counts where its whole sequence stands. Null and empty texts, on either side, match
    nothing. Rows that repeat an id are matched one by one; null ids stay null. Shingles are
    told apart by 64-bit hashes.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def finder(index: Index):
        ids = pa.array(index.ids, pa.int64())
        sizes = np.array([len(s) for s in index.sets], np.int64)

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                doc, item, shared = index.search(batch.column(1))
                columns = [batch.column(0).take(pa.array(doc)), ids.take(pa.array(item)), pa.array(sizes[item]), pa.array(shared), pa.array(shared / sizes[item])]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in OUT.split(", ")])

        return find

    passes = [rows.mapInArrow(finder(index), OUT) for index in blocks(items, width, share, block_bytes)]
    return reduce(DataFrame.unionByName, passes) if passes else docs.sparkSession.createDataFrame([], OUT)


def without_items(docs: DataFrame, items: DataFrame, width: int = WIDTH, share: int = SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents that contain no item; all columns stay. Same rules as :func:`contained`."""
    small_batches(docs.sparkSession, STAGE_BATCH_BYTES)
    at = docs.columns.index("text")

    def keeper(index: Index):
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[index.search(batch.column(at))[0]] = False
                yield batch.filter(pa.array(clean))
                release()

        return keep

    for index in blocks(items, width, share, block_bytes):
        docs = docs.mapInArrow(keeper(index), docs.schema)
    return docs
