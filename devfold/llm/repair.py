"""Token-id files compressed by pair replacement, readable from any position.

Documents lie in ascending id order in shards. In a shard, frequent pairs of neighbouring
symbols become nonterminals, round by round: a round counts all pairs, takes the most
frequent ones as new rules and replaces where they do not overlap, until no pair has the least
number of uses. Each rule keeps how many
ids it expands to, so a reader finds the symbols of any id range by a running sum and
expands those alone.

A file row is one shard (``shard``, ``tokens``, ``payload``), stored as Parquet by Spark.
``payload`` is little-endian: ``RPG1``; 64-bit counts of documents, rules, symbols and the first nonterminal;
document ids (64-bit) and 8-bit marks of null ids; ends of documents (64-bit); left and right of each rule and
its expansion length (32-bit); the symbols (32-bit).
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devfold.llm import encode
from devfold.llm import words as W
from devfold.llm.common import group_of, id_and_text, ranges_of, release, running_total, small_batches
from devfold.session import scratch_path

END_ID = 2
#: Text of one shard.
SHARD_BYTES = 4 << 20
#: New rules a round, and uses under which a pair gets no rule.
ROUND_RULES, LEAST_USES = 4096, 6
#: Pairs are counted exactly, not in hash cells, once a round shortens the sequence by less than this share.
LEAST_GAIN = 0.02
#: Pairs are counted in hash cells, at most this power of two.
MOST_CELLS = 22


@dataclass
class Shard:
    doc_ids: np.ndarray
    nulls: np.ndarray
    ends: np.ndarray
    base: int
    rules: np.ndarray
    sizes: np.ndarray
    symbols: np.ndarray

    def pack(self) -> bytes:
        head = np.array([len(self.doc_ids), len(self.rules), len(self.symbols), self.base], "<i8")
        parts = (head, self.doc_ids.astype("<i8"), self.nulls.astype("i1"), self.ends.astype("<i8"), self.rules.astype("<u4"), self.sizes.astype("<u4"), self.symbols.astype("<u4"))
        return b"RPG1" + b"".join(np.ascontiguousarray(x).tobytes() for x in parts)

    @classmethod
    def unpack(cls, raw: bytes) -> Shard:
        if raw[:4] != b"RPG1":
            raise ValueError("not a shard of this format")
        docs, rules, symbols, base = np.frombuffer(raw, "<i8", 4, 4).tolist()
        out, at = [], 36
        for kind, n in (("<i8", docs), ("i1", docs), ("<i8", docs), ("<u4", 2 * rules), ("<u4", rules), ("<u4", symbols)):
            out.append(np.frombuffer(raw, kind, n, at))
            at += n * np.dtype(kind).itemsize
        ids, nulls, ends, pairs, sizes, seq = out
        return cls(ids, nulls, ends, base, pairs.reshape(-1, 2), sizes, seq)

    def expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rules in a row, and where each begins; rules of one depth are filled together."""
        ends = np.concatenate([[0], np.cumsum(self.sizes.astype(np.int64))])
        out = np.empty(int(ends[-1]), np.uint32)
        child = self.rules.astype(np.int64) - self.base
        depth, before = np.zeros(len(child), np.int64), None
        while before is None or (depth != before).any():  # a rule uses earlier ones only
            before = depth
            depth = 1 + np.where(child >= 0, depth[np.maximum(child, 0)], 0).max(1) if len(child) else depth
        for level in range(1, int(depth.max(initial=0)) + 1):
            own = np.flatnonzero(depth == level)
            at = ends[own]
            for side in (0, 1):
                part = child[own, side]
                plain = part < 0
                out[at[plain]] = self.rules[own[plain], side]
                part, place = part[~plain], at[~plain]
                size = ends[part + 1] - ends[part]
                out[W.runs(place, size)] = out[W.runs(ends[part], size)]
                at = at.copy()
                at[plain] += 1
                at[~plain] += size
        return out, ends

    def _lengths(self, symbols: np.ndarray) -> np.ndarray:
        size = np.ones(len(symbols), np.int64)
        rule = symbols >= self.base
        size[rule] = self.sizes[symbols[rule] - self.base]
        return size

    def decode(self, start: int = 0, stop: int | None = None, expanded: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard; only the symbols that hold them are expanded."""
        flat, bounds = expanded or self.expansions()
        symbols = self.symbols.astype(np.int64)
        size = self._lengths(symbols)
        ends = np.cumsum(size)
        stop = int(ends[-1]) if stop is None and len(ends) else stop or 0
        if stop <= start:
            return np.zeros(0, np.uint32)
        a, b = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left")) + 1
        symbols, size, skipped = symbols[a:b], size[a:b], start - int(ends[a - 1] if a else 0)
        places = np.cumsum(size) - size
        out = np.empty(int(size.sum()), np.uint32)
        rule = symbols >= self.base
        out[places[~rule]] = symbols[~rule]
        out[W.runs(places[rule], size[rule])] = flat[W.runs(bounds[symbols[rule] - self.base], size[rule])]
        return out[skipped : skipped + stop - start]


def _cells(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash cell of each pair, and how many each cell has."""
    power = min(MOST_CELLS, max(12, (len(left) + 1).bit_length()))
    cell = (left * np.uint32(0x9E3779B1) ^ right * np.uint32(0x85EBCA77)) >> np.uint32(32 - power)
    return cell, np.bincount(cell, minlength=1 << power)


def _by_cell(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent pairs by counts of hash cells, the places where they stand, and which pair stands there."""
    cell, counts = _cells(left, right)
    top = _most(counts)
    rank = np.full(len(counts), len(top), np.uint16)
    rank[top] = np.arange(len(top))
    owner = rank[cell]
    hit = np.flatnonzero(owner < len(top))
    owner = owner[hit]
    pair = np.zeros((len(top), 2), np.uint32)  # one pair speaks for each cell: its first
    pair[owner[::-1], 0], pair[owner[::-1], 1] = left[hit[::-1]], right[hit[::-1]]
    same = (left[hit] == pair[owner, 0]) & (right[hit] == pair[owner, 1])
    hit, owner = hit[same], owner[same]
    # without the others of its cell, a pair may have too few uses
    enough = np.bincount(owner, minlength=len(top)) >= LEAST_USES
    number = np.cumsum(enough) - 1
    held = enough[owner]
    return pair[enough], hit[held], number[owner[held]]


def _by_pair(left: np.ndarray, right: np.ndarray, places: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`_by_cell`, by the pairs themselves; last, all places of pairs with enough uses.

    ``places`` holds those where such a pair can stand; without it, pairs in cells of fewer uses need no sorting.
    """
    if places is None:
        cell, counts = _cells(left, right)
        places = np.flatnonzero((counts >= LEAST_USES)[cell])
    if not len(places):
        return np.zeros((0, 2), np.uint32), places, places, places
    keys = left[places].astype(np.uint64) << np.uint64(32) | right[places]
    order = np.argsort(keys, kind="stable")
    keys, order = keys[order], places[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    count = np.diff(np.append(first, len(keys)))
    top = _most(count)
    hit = order[W.runs(first[top], count[top])]
    owner = np.repeat(np.arange(len(top)), count[top])
    place = np.argsort(hit, kind="stable")
    key = keys[first[top]]
    live = order[np.repeat(count >= LEAST_USES, count)]
    return np.stack([key >> np.uint64(32), key & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32), hit[place], owner[place], live


def _most(counts: np.ndarray) -> np.ndarray:
    """Where the ``ROUND_RULES`` highest counts of at least ``LEAST_USES`` are, highest first."""
    top = np.flatnonzero(counts >= LEAST_USES)
    if len(top) > ROUND_RULES:
        top = top[np.argpartition(counts[top], -ROUND_RULES)[-ROUND_RULES:]]
    return top[np.lexsort((top, -counts[top]))]


def compress(ids: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rules, their expansion lengths and the shortened sequence, in which no pair has ``LEAST_USES``. Lossless for any input."""
    seq = ids.astype(np.uint32)
    rules, sizes = [np.zeros((0, 2), np.uint32)], np.zeros(0, np.int64)
    exact, live = False, None
    while len(seq) > 1:
        before = len(seq)
        left, right = seq[:-1], seq[1:]
        if exact:
            pair, hit, owner, live = _by_pair(left, right, live)
        else:
            pair, hit, owner = _by_cell(left, right)
        if not len(pair):
            if exact:
                break
            exact = True
            continue
        order = np.full(before - 1, len(pair), np.uint16)
        order[hit] = owner
        padded = np.concatenate([[len(pair)], order, [len(pair)]]).astype(np.uint16)
        here = padded[hit + 1]
        # a pair goes where it beats its neighbours; in a run of one symbol, every second pair
        opens = np.ones(len(hit), bool)
        opens[1:] = (hit[1:] != hit[:-1] + 1) | (here[1:] != here[:-1])
        start = np.maximum.accumulate(np.where(opens, np.arange(len(hit)), 0))
        wins = (here < padded[hit])[start] & ((np.arange(len(hit)) - start) % 2 == 0)
        chosen = hit[wins & (here <= padded[hit + 2])]
        used = np.bincount(order[chosen], minlength=len(pair)) > 0
        pair, number = pair[used], np.cumsum(used) - 1
        new = (base + len(sizes) + number[order[chosen]]).astype(np.uint32)
        kept = np.ones(before, bool)
        kept[chosen + 1] = False
        seq[chosen] = new
        seq = seq[kept]
        if exact:  # old pairs only get rarer, and each new one has a new symbol
            at = np.cumsum(kept, dtype=np.int32) - 1
            fresh = at[chosen]
            held = np.zeros(len(seq) + 1, bool)  # the last one is what lies before the first symbol
            held[at[live[kept[live]]]] = held[fresh - 1] = held[fresh] = True
            live = np.flatnonzero(held[: len(seq) - 1])
        known = np.concatenate([sizes, np.zeros(0, np.int64)])
        width = [np.where(pair[:, i] < base, 1, known[np.maximum(pair[:, i].astype(np.int64) - base, 0)] if len(known) else 1) for i in (0, 1)]
        rules.append(pair)
        sizes = np.concatenate([sizes, width[0] + width[1]])
        exact = exact or before - len(seq) < LEAST_GAIN * before
    return np.concatenate(rules), sizes, seq


def write_shards(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> str:
    """Encode every text and write the shards to ``path``.

    A null or empty text is the end id alone. Rows with a null id come first, equal ids
    are ordered by text. An empty table writes an empty folder of the same schema.
    Only ``doc_id`` and ``text`` are read.
    """
    file = vocabulary or encode.vocabulary()
    rows = id_and_text(docs)
    cuts, _ = ranges_of(rows, shard_bytes)

    def build(key: tuple, table: pa.Table) -> pa.Table:
        encoder = encode.encoder(file)
        table = table.take(_order(table))
        ids, bounds = encode.with_end(*encoder.encode(table.column("text")), end_id)
        base = max(encoder.tokenizer.get_vocab_size(), end_id + 1)
        keys = table.column("doc_id").combine_chunks()
        rules, sizes, seq = compress(ids, base)
        shard = Shard(keys.fill_null(0).to_numpy(), keys.is_null().to_numpy(zero_copy_only=False), bounds[1:], base, rules, sizes, seq)
        release()
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "tokens": pa.array([len(ids)], pa.int64()), "payload": pa.array([shard.pack()], pa.binary())})

    sharded = rows.withColumn("shard", group_of(cuts)).groupBy("shard")
    sharded.applyInArrow(build, "shard int, tokens long, payload binary").write.mode("overwrite").parquet(path)
    return path


def _order(table: pa.Table) -> pa.Array:
    """Row order by id, then text, nulls first."""
    import pyarrow.compute as pc

    order = pc.sort_indices(table.select(["doc_id"]), sort_keys=[("doc_id", "ascending")], null_placement="at_start")
    keys = table.column("doc_id")
    if pc.count_distinct(keys, mode="all").as_py() < len(keys):
        order = pc.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("text", "ascending")], null_placement="at_start")
    return order


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row for each stored document: where its ids start, their number and crc32."""
    files = spark.read.parquet(path)

    def unfold(batches):
        for batch in batches:
            for shard, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = Shard.unpack(raw)
                ids = memoryview(own.decode().astype("<u4")).cast("B")
                ends = own.ends.tolist()
                starts = [0, *ends[:-1]]
                crc = [zlib.crc32(ids[4 * s : 4 * e]) for s, e in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ends), shard), pa.int32()),
                        pa.array(own.doc_ids.astype(np.int64), mask=own.nulls.astype(bool)),
                        pa.array(starts, pa.int64()),
                        pa.array(np.diff([0, *ends]), pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["shard", "doc_id", "_at", "n_tokens", "ids_crc32"],
                )
            release()

    small_batches(spark)
    found = files.select("shard", "payload").mapInArrow(unfold, "shard int, doc_id long, _at long, n_tokens long, ids_crc32 long")
    bases = running_total(files.select("shard", "tokens"), "shard", "tokens", "_base").select("shard", "_base")
    return found.join(bases, "shard").select("doc_id", (F.col("_base") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, path: str | None = None, **options: object) -> DataFrame:
    """Write the files (to the shared folder when no path is given) and read them back."""
    spark = docs.sparkSession
    return read_documents(spark, write_shards(docs, path or scratch_path(spark, "repair"), **options))
