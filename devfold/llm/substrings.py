"""Removal of repeated word windows.

Documents lie in consecutive id ranges. Every window of ``width`` words of a range gets a
Rabin-Karp hash; a range sends each distinct hash once to a bucket, where hashes of all
ranges are counted. The bucket answers each range with marks for the hashes that a smaller
range has too. Back in the range (whose texts Spark keeps in the same shuffle), a window goes
if its hash is marked or started earlier in the range, and the windows that go merge into
maximal intervals of words. A passage that a third of all documents share costs one hash per
range in its bucket, whatever the number of documents.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devfold.llm import words as W
from devfold.llm.common import group_of, id_and_text, ranges_of
from devfold.llm.jaccard import bucketed
from devfold.llm.repair import _order

WIDTH = 20
#: Text of one range, and windows counted in one bucket, about.
RANGE_BYTES, BUCKET_ROWS = 4 << 20, 1_500_000


def squeeze(keys: np.ndarray) -> bytes:
    """Ascending keys as differences, byte planes apart: most high bytes are zero and compress."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unsqueeze(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def range_windows(table: pa.Table, width: int) -> tuple[pa.Table, W.Words, np.ndarray, np.ndarray]:
    """The documents of a range in order, their words, window hashes and window starts."""
    table = table.take(_order(table))
    words = W.split(table.column("text"))
    keys, start = W.windows(W.word_hashes(words), words.first, width)
    return table, words, keys, start


def intervals(words: W.Words, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of covered words: text, first word and end within the text."""
    edge = np.zeros(len(words.start) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + width, -1)
    covered = np.cumsum(edge[:-1]) > 0
    before = np.concatenate([[False], covered[:-1]])
    after = np.concatenate([covered[1:], [False]])
    held = words.counts > 0
    before[words.first[:-1][held]] = False
    after[words.first[1:][held] - 1] = False
    first, last = np.flatnonzero(covered & ~before), np.flatnonzero(covered & ~after)
    text = np.searchsorted(words.first, first, "right") - 1
    return text, first - words.first[text], last + 1 - words.first[text]


def removals(docs: DataFrame, width: int = WIDTH, range_bytes: int = RANGE_BYTES, output: str = "digest") -> DataFrame:
    """What each document loses.

    ``output="digest"``: ``doc_id, n_words, n_removed, kept_sha256``.
    ``output="text"``: ``doc_id, spans, kept`` with the intervals as ``first:end`` of words,
    comma-joined, and the words that stay, joined by one space.

    "Earlier" is a smaller id or, in one document, an earlier start; null ids come first and
    rows of equal id are ordered by text. A null text has no words. Empty tables give no row;
    only ``doc_id`` and ``text`` are read. Windows are told apart by 64-bit hashes.
    """
    rows = id_and_text(docs)
    cuts, size = ranges_of(rows, range_bytes)
    buckets = max(12, size // 6 // BUCKET_ROWS)
    ranged = rows.withColumn("range", group_of(cuts))
    schemas = {
        "digest": "doc_id long, n_words long, n_removed long, kept_sha256 string",
        "text": "doc_id long, spans string, kept string",
    }

    def send(key: tuple, table: pa.Table) -> pa.Table:
        _, _, keys, _ = range_windows(table, width)
        keys = np.unique(keys)
        order, bounds = bucketed(keys, buckets)  # unique keys ascend, and so do their buckets
        held = np.flatnonzero(np.diff(bounds))
        return pa.table(
            {
                "range": pa.array(np.full(len(held), key[0].as_py()), pa.int32()),
                "bucket": pa.array(held, pa.int32()),
                "keys": pa.array([squeeze(keys[bounds[b] : bounds[b + 1]]) for b in held], pa.binary()),
            }
        )

    def count(table: pa.Table) -> pa.Table:
        table = table.sort_by("range")
        each = [unsqueeze(x) for x in table.column("keys").to_pylist()]
        ends = np.cumsum([len(x) for x in each])
        keys = np.concatenate(each)
        order = np.argsort(keys, kind="stable")
        again = np.zeros(len(keys), bool)
        again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
        marks = np.split(again, ends[:-1])
        hit = [i for i, m in enumerate(marks) if m.any()]
        return pa.table(
            {
                "range": table.column("range").take(pa.array(hit, pa.int64())),
                "marked": pa.array([squeeze(each[i][marks[i]]) for i in hit], pa.binary()),
            },
            schema=pa.schema([("range", pa.int32()), ("marked", pa.binary())]),
        )

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        table, words, keys, start = range_windows(left, width)
        goes = np.zeros(len(keys), bool)
        _, first = np.unique(keys, return_index=True)
        goes[:] = True
        goes[first] = False
        if right.num_rows:
            goes |= np.isin(keys, np.concatenate([unsqueeze(x) for x in right.column("marked").to_pylist()]))
        text, begin, end = intervals(words, start[goes], width)
        raw = words.data.tobytes()
        split = np.searchsorted(text, np.arange(table.num_rows + 1))
        out: dict[str, list] = {field.split()[0]: [] for field in schemas[output].split(", ")}
        out["doc_id"] = table.column("doc_id")
        for i in range(table.num_rows):
            spans = list(zip(begin[split[i] : split[i + 1]].tolist(), end[split[i] : split[i + 1]].tolist(), strict=True))
            own = raw[words.offsets[i] : words.offsets[i + 1]].split()
            n = len(own)
            for a, b in reversed(spans):
                del own[a:b]
            kept = b" ".join(own)
            if output == "digest":
                out["n_words"].append(n)
                out["n_removed"].append(n - len(own))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            else:
                out["spans"].append(",".join(f"{a}:{b}" for a, b in spans))
                out["kept"].append(kept.decode())
        return pa.table(out)

    sent = ranged.groupBy("range").applyInArrow(send, "range int, bucket int, keys binary")
    answers = sent.groupBy("bucket").applyInArrow(count, "range int, marked binary")
    return ranged.groupBy("range").cogroup(answers.groupBy("range")).applyInArrow(cut, schemas[output])
