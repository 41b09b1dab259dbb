"""N-gram Jaccard join: components of documents whose shingle sets nearly agree.

Two sets that link differ in few elements, so of ``d + 1`` hash segments one is equal in
both. Larger sets get fewer segments, of which some are equal in both but for a chance of ``exp(-30)``,
and only those with several elements count. Documents that share a segment's signature are joined into coarse components (a
superset of the links). Shingles that a share of all documents hold are left out of the
signatures where enough others remain: that loses no link either, and keeps passages that
many documents share from joining them. The sets of a coarse component then
meet in blocks, where a prefix tree finds the links. Exact copies stand for one set. A
component too large for one block is cut by set size; its parts are joined through
representatives, and what stays apart is compared with the parts that hold sets of like size.
No pairs of a group are listed: signatures give stars, blocks give spanning links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from devfold.llm import trie
from devfold.llm import words as W
from devfold.llm.common import free_name, id_and_text, release, small_batches, written
from devfold.llm.components import components

WIDTH, SHARE = 3, 90
#: Bytes of sets that one block holds, and of text whose signatures one bucket holds, about.
BLOCK_BYTES, BUCKET_BYTES = 8 << 20, 4 << 20
#: Coarse members (16 bytes each) up to which their list is broadcast to the texts.
BROADCAST_ROWS = 1_000_000
#: Bytes of a signature that travel beside its bucket; equal by chance, they only widen a coarse component.
KEY_BYTES = 5
#: One signature in so many meets first, so that near copies are known as such before the others meet.
LEAD = 16
#: Common segments that linked large sets have on average at the least, and elements that make a segment count at most.
EXPECTED, MOST_ELEMENTS = 30, 8
#: A shingle is common in one of so many documents, but not in fewer than this.
COMMON_SHARE, COMMON = 500, 8
#: Documents, and shingles, up to which a run is counted at once.
RUN_ROWS, RUN_SHINGLES = 4096, 4 << 20


def shingles(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, int]:
    """Shingle hashes of all texts, with repeats, the text of each, and the number of texts.

    A text of fewer than ``width`` words has its whole sequence as one shingle; one without words has none.
    """
    words = W.split(texts, lower=True)
    hashes = W.word_hashes(words)
    keys, start = W.windows(hashes, words.first, width)
    text = np.repeat(np.arange(len(words.first) - 1), np.maximum(words.counts - width + 1, 0))
    for size in range(1, width):
        few = np.flatnonzero(words.counts == size)
        if len(few):
            whole = hashes[words.first[few][:, None] + np.arange(size)]
            key = W.mix((whole * W.powers(W.WORD_BASE, size)[0][:size]).sum(1) + np.uint64(size))
            keys, text = np.concatenate([keys, key]), np.concatenate([text, few])
    return keys, text, len(words.first) - 1


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, in a row, and their bounds."""
    keys, text, number = shingles(texts, width)
    order = np.lexsort((keys, text))
    keys, text = keys[order], text[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
    return keys[new], np.searchsorted(text[new], np.arange(number + 1))


def size_class(sizes: np.ndarray, share: int) -> np.ndarray:
    """Sizes within a factor of ``share`` percent fall into equal or neighbouring classes."""
    return np.floor(np.log(np.maximum(sizes, 1)) / math.log(100 / share) + 1e-9).astype(np.int64)


def segments(classes: np.ndarray, share: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of segments for sets of at most this class, and how many of them may be empty.

    Linked sets differ in at most ``d`` elements, so ``d + 1 + spare`` segments leave more than
    ``spare`` untouched. A set with no more than ``spare`` empty segments therefore shares a filled
    one; ``spare`` is set so far above the expected number of empty segments that few exceed it.
    """
    most = np.ceil((100 / share) ** (classes + 1.0)) + 1
    least = most * (share / 100) ** 2
    apart = np.floor((100 - share) * 2 * most / (100 + share)) + 1
    spare = np.zeros_like(apart)
    for _ in range(4):
        empty = (apart + spare) * np.exp(-least / (apart + spare))
        spare = np.where(apart > 1, np.ceil(empty + 4 * np.sqrt(empty)), 0)
    return (apart + spare).astype(np.int64), spare.astype(np.int64)


def _segment_sums(keys: np.ndarray, bounds: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sums over the ``count`` segments of each set in a row, the elements that fell there, the set and the segment's number in it."""
    text = np.repeat(np.arange(len(count)), np.diff(bounds))
    keys, text = keys[count[text] > 0], text[count[text] > 0]
    ends = np.cumsum(count)
    slot = (ends - count)[text] + (((keys >> np.uint64(32)) * count[text].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
    sums = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    held = np.bincount(slot, minlength=len(sums))
    if len(slot):
        first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        sums[slot[first]] = np.add.reduceat(W.mix(keys), first)
    owner = np.repeat(np.arange(len(count)), count)
    return sums, held, owner, np.arange(len(owner)) - np.repeat(ends - count, count)


def expected(sizes: np.ndarray, counted: np.ndarray, number: np.ndarray, least: np.ndarray, share: int) -> np.ndarray:
    """Segments that a set has in common with any set it links with, and that hold ``least`` elements, at the least expected.

    A linked set differs in at most ``(100 / share - 1) * size`` elements and lacks at most ``(1 - share / 100) * size`` of the
    ``counted`` ones; elements fall into the ``number`` segments by their hash.
    """
    held = np.maximum(counted - sizes * (1 - share / 100), 0) / number
    fewer = sum(np.where(k < least, held**k / math.factorial(k), 0) for k in range(MOST_ELEMENTS))
    return number * np.exp(-sizes * (100 / share - 1) / number) * (1 - np.exp(-held) * fewer)


@lru_cache(maxsize=None)
def layout(size: int, share: int) -> tuple[int, int, int]:
    """Number of segments for sets of a size class, how many may be empty, and the elements that make one count.

    Sets large enough get few and full segments: as many as leave ``EXPECTED`` common ones of two elements or more,
    so that a link goes unseen with a chance below ``exp(-EXPECTED)``. Smaller sets get so many that none can.
    """
    most = math.ceil((100 / share) ** (size + 1.0)) + 1
    ends = np.array([[most * (share / 100) ** 2], [most]])
    numbers = np.unique(np.geomspace(4, max(5, most), 400).astype(np.int64))
    for least in range(MOST_ELEMENTS, 1, -1):
        enough = (expected(ends, ends, numbers, np.int64(least), share) >= EXPECTED).all(0)
        if enough.any():
            return int(numbers[enough.argmax()]), 0, least
    number, spare = segments(np.array([size]), share)
    return int(number[0]), int(spare[0]), 1


def signatures(keys: np.ndarray, bounds: np.ndarray, share: int = SHARE, rare: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the segments of each set, under its own size class and the next; and the set of each.

    ``rare`` marks the elements that count. A set that has too few of them to be sure of a common
    segment also sends the segments of all its elements: of two linked sets
    either one has enough of them, and that one's surety holds for both, or both send all.
    """
    sizes = np.diff(bounds)
    out, owners = [], []
    few = (keys, bounds) if rare is None else (keys[rare], np.concatenate([[0], np.cumsum(rare)])[bounds])
    for step in (0, 1):
        classes = size_class(sizes, share) + step
        present, which = np.unique(classes, return_inverse=True)
        number_of, spare, least = np.array([layout(int(c), share) for c in present], np.int64).reshape(-1, 3)[which].T
        count = np.where(sizes > 0, number_of, 0)
        for whole, (elements, limits) in enumerate((few, (keys, bounds))):
            sums, held, owner, number = _segment_sums(elements, limits, count)
            too_empty = count - np.bincount(owner, held > 0, len(sizes)).astype(np.int64) > spare
            unsure = np.where(least > 1, expected(sizes, np.diff(limits), number_of, least, share) < EXPECTED, too_empty) & (count > 0)
            # empty segments count only where even all elements of a small set leave too many of them
            sent = (held >= least[owner]) | ((whole == 1) & too_empty & (least == 1))[owner]
            tag = classes[owner[sent]] * 2**32 + whole * 2**31 + number[sent]
            out.append(W.mix(sums[sent] + W.mix(tag.astype(np.uint64))))
            owners.append(owner[sent])
            count = np.where(unsure, count, 0)
    return np.concatenate(out), np.concatenate(owners)


def bucketed(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of keys by bucket, and bounds of the buckets in it."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    order = np.argsort(bucket.astype(np.uint32 if buckets > 65536 else np.uint16), kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))


def stars(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For equal keys: edges from each document to the smallest one; and the position of that one for each distinct key."""
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
    hub = docs[np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))] if len(keys) else docs
    far = hub != docs
    return np.unique(np.stack([hub[far], docs[far]], 1), axis=0), keys[first], docs[first]


def places(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are among the ascending ``known`` ones, and where."""
    at = np.searchsorted(known, keys)
    inside = at < len(known)
    inside[inside] = known[at[inside]] == keys[inside]
    return inside, at


def runs(pieces: Iterator[tuple[np.ndarray, int]]) -> Iterator[tuple[np.ndarray, int]]:
    """Pieces (shingles, number of texts) put together to runs of ``RUN_ROWS`` texts, or half of ``RUN_SHINGLES``, about.

    What comes last is held back with the run before it: in a run of few texts every shingle would be held often.
    """
    held: list[tuple[np.ndarray, int]] = []
    for keys, texts in pieces:
        while held and (sum(n for _, n in held) + texts > 2 * RUN_ROWS or sum(len(k) for k, _ in held) + len(keys) > RUN_SHINGLES):
            full = np.cumsum([n for _, n in held]) > RUN_ROWS
            full |= np.cumsum([len(k) for k, _ in held]) > RUN_SHINGLES // 2
            take = max(1, int(full.argmax()) if full.any() else len(held))
            yield np.concatenate([k for k, _ in held[:take]]), sum(n for _, n in held[:take])
            held = held[take:]
        held.append((keys, texts))
    if held:
        yield np.concatenate([k for k, _ in held]), sum(n for _, n in held)


def common_shingles(docs: DataFrame, size: int, width: int) -> np.ndarray:
    """Shingles that one of ``COMMON_SHARE`` documents holds, and ``COMMON`` of them, ascending; counted in all documents.

    A run of documents reports what it holds at least half as often as a common shingle would be held on average. All that the
    runs leave unreported of a shingle is less than half of what makes it common, so only shingles of which
    the other half is reported come into question: their number is bounded by the length of the texts, not by how many there are.
    These are then counted in all documents. ``size`` is the bytes of text.
    """
    number = docs.count()
    least = max(COMMON, -(-number // COMMON_SHARE))
    if number < least:
        return np.zeros(0, np.uint64)
    # runs reach over whole partitions, so those of few documents are put together
    rows = docs.select("text").coalesce(max(1, number // RUN_ROWS, size // BUCKET_BYTES))

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = (batch.column(0).slice(at, RUN_ROWS // 8) for batch in batches for at in range(0, batch.num_rows, RUN_ROWS // 8))
        for held, texts in runs((keys, new) for keys, _, new in (shingles(part, width) for part in cut)):
            keys = np.sort(held)
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
            count = np.diff(np.append(first, len(keys)))
            often = 2 * number * count >= texts * least
            yield pa.RecordBatch.from_arrays([pa.array(keys[first[often]].view(np.int64)), pa.array(count[often])], names=["key", "n"])
        release()

    reported = rows.mapInArrow(report, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    asked = np.sort(reported.where(F.col("n") * 2 > least).select("key").toArrow().column(0).to_numpy().view(np.uint64))
    if not len(asked):
        return asked

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(asked), np.int64)
        for batch in batches:
            keys, text, _ = shingles(batch.column(0), width)
            inside, at = places(asked, keys)
            once = np.unique(text[inside] * len(asked) + at[inside])
            count += np.bincount(once % len(asked), minlength=len(asked))
        release()
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(asked[held].view(np.int64)), pa.array(count[held])], names=["key", "n"])

    counted = docs.select("text").mapInArrow(tally, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return np.sort(counted.where(F.col("n") >= least).select("key").toArrow().column(0).to_numpy().view(np.uint64))


def signed(docs: DataFrame, width: int, share: int, ignored: np.ndarray) -> DataFrame:
    """Each document's id with its signatures, eight bytes each: one in ``LEAD`` of them in ``lead``, the others in ``rest``."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, bounds = shingle_sets(batch.column(1), width)
            keys, owner = signatures(keys, bounds, share, ~places(ignored, keys)[0])
            order = np.argsort(owner, kind="stable")
            keys, owner = keys[order].astype("<u8"), owner[order]
            lead = (keys >> np.uint64(40)) % np.uint64(LEAD) == 0
            cells = [W.ragged(keys[which], np.searchsorted(owner[which], np.arange(batch.num_rows + 1))) for which in (lead, ~lead)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cells], names=["doc_id", "lead", "rest"])
            release()

    return docs.where("doc_id IS NOT NULL").mapInArrow(sign, "doc_id long, lead binary, rest binary")


def meetings(rows: DataFrame, buckets: int) -> DataFrame:
    """Edges ``(src, dst)`` that connect all labels of ``rows(label, keys)`` that have a key in common, once for each batch and bucket."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column(1).to_pylist()
            keys = np.frombuffer(b"".join(given), "<u8").astype(np.uint64)
            edges, keys, hubs = stars(keys, np.repeat(batch.column(0).to_numpy(), [len(x) // 8 for x in given]))
            order, bounds = bucketed(keys, buckets)
            keys, hubs = keys[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES], hubs[order]
            held = np.flatnonzero(np.diff(bounds))
            cells = [keys[bounds[b] : bounds[b + 1]].tobytes() + hubs[bounds[b] : bounds[b + 1]].tobytes() for b in held]
            if len(edges):
                held = np.append(held, held[0])
                cells.append(edges.T.tobytes())
            marks = np.zeros(len(held), bool)
            marks[len(held) - (len(edges) > 0) :] = True
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(marks), pa.array(cells, pa.binary())], names=["bucket", "edges", "cell"])
            release()

    def meet(table: pa.Table) -> pa.Table:
        edges, keys, hubs = [], [], []
        for done, cell in zip(table.column("edges").to_pylist(), table.column("cell").to_pylist(), strict=True):
            if done:
                edges.append(np.frombuffer(cell, np.int64).reshape(2, -1).T)
                continue
            size = len(cell) // (KEY_BYTES + 8)
            wide = np.zeros((size, 8), np.uint8)
            wide[:, :KEY_BYTES] = np.frombuffer(cell, np.uint8, size * KEY_BYTES).reshape(size, KEY_BYTES)
            keys.append(wide.view("<u8").ravel())
            hubs.append(np.frombuffer(cell[size * KEY_BYTES :], np.int64))
        if keys:
            edges.append(stars(np.concatenate(keys), np.concatenate(hubs))[0])
        found = np.concatenate(edges).astype(np.int64)
        release()
        return pa.table({"src": found[:, 0], "dst": found[:, 1]})

    return rows.mapInArrow(deal, "bucket int, edges boolean, cell binary").groupBy("bucket").applyInArrow(meet, "src long, dst long")


def coarse(docs: DataFrame, width: int = WIDTH, share: int = SHARE) -> DataFrame:
    """Edges ``(src, dst)`` that connect all documents sharing a segment signature, directly or not.

    Near copies share most of their signatures and would meet in nearly every bucket, the more often the more buckets there are.
    So one in ``LEAD`` of the signatures meet first, and documents that these connect go by one label when the others meet:
    what is connected already makes no edge again.
    """
    small_batches(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = written(signed(docs, width, share, common_shingles(docs, size, width)))
    first = written(components(meetings(rows.select("doc_id", "lead"), max(12, size // (LEAD * BUCKET_BYTES)))))
    label = F.coalesce("component", "doc_id").alias("label")
    named = rows.join(_small(first), rows.doc_id == first.node, "left").select(label, "rest")
    joined = first.where("node <> component").select(F.col("component").alias("src"), F.col("node").alias("dst"))
    return joined.unionByName(meetings(named, max(12, size // BUCKET_BYTES)))


def sized(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Document ids with the size of their shingle set."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, bounds = shingle_sets(batch.column(1), width)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(bounds))], names=["doc_id", "n_shingles"])

    return docs.mapInArrow(count, "doc_id long, n_shingles long")


def grouped_links(rows: DataFrame, share: int) -> DataFrame:
    """Links within each ``(coarse, part)`` of rows ``(coarse, part, label, doc_id, cell)``."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, []

        def flush() -> pa.RecordBatch:
            sets = [np.frombuffer(x["cell"], np.uint64) for x in held]
            labels = [x["label"] for x in held]
            pairs = trie.links(sets, share, labels)
            ids = [x["doc_id"] for x in held]
            if len(held) > 100:
                release()
            return pa.RecordBatch.from_arrays([pa.array([ids[a] for a, _ in pairs], pa.int64()), pa.array([ids[b] for _, b in pairs], pa.int64())], names=["src", "dst"])

        for batch in batches:
            for row in batch.to_pylist():
                if (row["coarse"], row["part"]) != block:
                    if len(held) > 1:
                        yield flush()
                    block, held = (row["coarse"], row["part"]), []
                held.append(row)
        if len(held) > 1:
            yield flush()

    dealt = rows.select("coarse", "part", "label", "doc_id", "cell").repartition("coarse", "part").sortWithinPartitions("coarse", "part", "doc_id")
    return dealt.mapInArrow(join, "src long, dst long")


def _small(df: DataFrame) -> DataFrame:
    """``df`` as a broadcast side where its rows are counted to be few, else as it is."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _parted(rows: DataFrame, block_bytes: int) -> DataFrame:
    """Rows ``(coarse, doc_id, n, ...)`` with the part of their coarse component each falls into, and whether it has several.

    A component beyond ``block_bytes`` is cut by the size of the sets, as sets that link are of like size: sizes
    follow each other until half a block is full. A size that fills more than that is dealt over parts by a hash.
    """
    half = max(8, block_bytes // 2)
    large = rows.groupBy("coarse").agg((8 * F.sum("n")).alias("bytes")).where(F.col("bytes") > block_bytes).select("coarse")
    sizes = rows.join(_small(written(large)), "coarse").groupBy("coarse", "n").agg((8 * F.sum("n")).alias("bytes"))
    before = Window.partitionBy("coarse").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.select(
        "coarse", "n", F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / half).alias("first"), F.ceil(F.col("bytes") / half).alias("spread")
    )
    dealt = rows.join(_small(written(placed)), ["coarse", "n"], "left")
    part = F.col("first") + F.pmod(F.xxhash64("doc_id"), F.col("spread"))
    return dealt.withColumns({"part": F.coalesce(part, F.lit(0)).cast("long"), "several": F.col("first").isNotNull()}).drop("first", "spread")


def verified(docs: DataFrame, members: DataFrame, width: int, share: int, block_bytes: int) -> DataFrame:
    """True links ``(src, dst)`` that connect every component among ``members(doc_id, coarse)``."""
    rows = docs.join(_small(members), "doc_id").select("doc_id", "text", "coarse")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, bounds = shingle_sets(batch.column(1), width)
            sums = [np.concatenate([[0], np.cumsum(x, dtype=np.uint64)]) for x in (W.mix(keys), W.mix(keys ^ np.uint64(0x5851F42D4C957F2D)))]
            marks = [(x[bounds[1:]] - x[bounds[:-1]]).view(np.int64) for x in sums]
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(0), *map(pa.array, marks), pa.array(np.diff(bounds), pa.int64()), W.ragged(keys, bounds)], names=["coarse", "doc_id", "f1", "f2", "n", "cell"])
            release()

    schema = "coarse long, doc_id long, f1 long, f2 long, n long, cell binary"
    sets = written(rows.mapInArrow(build, schema).where("n > 0"))
    # the smallest document speaks for equal sets; cells move once, to their block
    first = written(sets.groupBy("coarse", "f1", "f2").agg(F.min("doc_id").alias("src")))
    copies = sets.select("coarse", "f1", "f2", F.col("doc_id").alias("dst")).join(first, ["coarse", "f1", "f2"]).where("src <> dst").select("src", "dst")
    alone = first.groupBy("coarse").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("coarse")
    heads = written(first.join(alone, "coarse", "left_anti").select("f1", "f2", F.col("src").alias("doc_id")))
    distinct = sets.join(_small(heads), ["f1", "f2", "doc_id"]).select("coarse", "doc_id", "n", "cell")
    parted = _parted(distinct, block_bytes).withColumn("label", F.col("doc_id"))
    links = written(grouped_links(parted, share))
    large = parted.where("several").drop("several", "part", "label")
    if large.isEmpty():
        return copies.unionByName(links)
    # representatives of what each part has joined meet in further rounds, as long as that shrinks
    ids = written(large.select("coarse", "doc_id"))
    while True:
        found = components(links)
        labels = written(ids.join(found, ids.doc_id == found.node, "left").select("coarse", "doc_id", F.coalesce("component", "doc_id").alias("label")))
        speak = labels.groupBy("coarse", "label").agg(F.min("doc_id").alias("doc_id"))
        apart = large.join(_small(written(speak)), ["coarse", "doc_id"])
        more = written(grouped_links(_parted(apart, block_bytes), share))
        if more.isEmpty():
            break
        links = written(links.unionByName(more))
    # what is still apart in a split component: every part against those with sets of like size, nothing left out
    unsettled = labels.groupBy("coarse").agg(F.count_distinct("label").alias("n")).where("n > 1").select("coarse")
    waiting = written(labels.join(unsettled, "coarse"))
    if not waiting.isEmpty():
        # the cut is that of the first round, so what shares a part has met there
        left = _parted(large.join(_small(waiting), ["coarse", "doc_id"]), block_bytes).where("several")
        bounds = written(left.groupBy(F.col("coarse").alias("_coarse"), F.col("part").alias("other")).agg(F.min("n").alias("lo"), F.max("n").alias("hi")))
        alike = (F.col("coarse") == F.col("_coarse")) & (F.col("part") != F.col("other")) & (share * F.col("lo") <= 100 * F.col("n")) & (100 * F.col("hi") >= share * F.col("n"))
        grid = left.join(_small(bounds), alike).withColumn("part", F.least("part", "other") * (1 << 31) + F.greatest("part", "other"))
        links = links.unionByName(grouped_links(grid, share))
    return copies.unionByName(links)


def near_components(rows: DataFrame, width: int, share: int, block_bytes: int) -> DataFrame:
    """``(node, component)`` of every document that links with another one."""
    near = written(coarse(rows, width, share))
    members = components(near).select(F.col("node").alias("doc_id"), F.col("component").alias("coarse"))
    return components(verified(rows, written(members), width, share, block_bytes))


def jaccard_components(docs: DataFrame, width: int = WIDTH, share: int = SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row.

    Two documents link when ``100 * intersection >= share * union`` of their distinct
    shingles. Null and empty texts have no shingles and link with nothing. A row with a null
    id has a null component. Rows that repeat an id are one document for the links, and each
    stays a row. Empty tables give no row; only ``doc_id`` and ``text`` are read.
    Shingles are told apart by 64-bit hashes.
    """
    rows = id_and_text(docs)
    found = near_components(rows, width, share, block_bytes).select(F.col("node").alias("doc_id"), "component")
    return sized(rows, width).join(found, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, width: int = WIDTH, share: int = SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents without those that another one of their component stands for; all columns stay, whatever they are called.

    The document with the smallest id stays. Rows whose id is null or comes again are told apart by a 64-bit hash of
    id and text, which then orders them: different texts under one id are different documents, and of
    rows alike in id and text one stays. Null and empty texts link with nothing. An empty table stays empty.
    """
    node, key = free_name(docs, "node"), F.col("doc_id").cast("long")
    again = written(docs.where("doc_id IS NOT NULL").groupBy(key.alias(node)).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(node))
    rows = docs.withColumn(node, key)
    if not again.isEmpty() or not docs.where("doc_id IS NULL").isEmpty():
        single = rows.where(F.col(node).isNotNull()).join(_small(again), node, "left_anti").select(*docs.columns, node)
        other = rows.where(F.col(node).isNull()).unionByName(rows.join(_small(again), node, "left_semi").select(*docs.columns, node))
        # equal rows combine before they move, however many there are
        once = other.groupBy(F.xxhash64(node, F.col("text").cast("string")).alias("_key")).agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("_row"))
        rows = written(single.unionByName(once.select("_row.*", F.col("_key").alias(node))))
    found = near_components(rows.select(F.col(node).alias("doc_id"), F.col("text").cast("string").alias("text")), width, share, block_bytes)
    gone = written(found.where("node <> component").select(F.col("node").alias(node)))
    return rows.join(_small(gone), node, "left_anti").select(docs.columns)
