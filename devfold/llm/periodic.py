"""Stretches of a text that repeat with a period, found by seeds that are extended along diagonals.

A run of period ``q`` and length ``n >= max(least, power * q)`` matches itself shifted by ``q`` over ``n - q``
words: a stretch of the diagonal ``q``. Lags are taken in bands ``[2**j, 2**(j + 1))``; the shortest overlap a
run of the band guarantees is the band's seed length. Equal seeds of one document are enumerated as
pairs of neighbouring occurrences: a seed is at least as long as its lag, so inside a run of smallest period ``q`` it
comes again after exactly ``q`` words and no sooner, and no other pair of the group is needed. A seed that
does not come twice cannot start a longer one, so each band looks only at what the one before found.
Pairs are extended in both directions on their diagonal, a table with the furthest word covered for each lag
skips the pairs that lie inside a stretch already extended. Map-only: a text meets nothing but itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devfold.llm import words as W
from devfold.llm.common import id_and_text, release, small_batches

#: Words a run has at least, and periods it has at least.
LEAST, POWER = 6, 4
RUN = "array<struct<start: long, length: long, period: long>>"
_STEP = 256


def bands(longest: int, least: int, power: int) -> list[tuple[int, int]]:
    """Lowest lag and seed length of each band up to lag ``longest``; seeds never get shorter from band to band.

    A run of lag ``q`` guarantees ``max(least, power * q) - q``, which is smallest at the band's lowest lag or where ``power * q`` passes ``least``.
    """
    lows = [1 << j for j in range(longest.bit_length())]
    sizes = [min(max(least, power * q) - q for q in (low, min(max(low, least // power), 2 * low - 1))) for low in lows]
    return list(zip(lows, np.minimum.accumulate(sizes[::-1])[::-1].tolist(), strict=True)) if lows else []


def seed_pairs(hashes: np.ndarray, first: np.ndarray, least: int, power: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and lag of neighbouring equal seeds of one document, for every lag a run may have."""
    up, down = W.powers(W.WORD_BASE, len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, W.U64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    counts = np.diff(first)
    start = np.arange(len(hashes))
    end = np.repeat(first[1:], counts)
    salt = W.mix(np.repeat(np.arange(1, len(counts) + 1), counts).astype(W.U64))
    places, lags = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for low, size in bands(int(counts.max(initial=0)) // power, least, power):
        fits = start + size <= end
        start, end, salt = start[fits], end[fits], salt[fits]
        keys = W.mix((sums[start + size] - sums[start]) * down[start]) ^ salt
        order = np.argsort(keys, kind="stable")
        same = keys[order[1:]] == keys[order[:-1]]
        here, lag = start[order[:-1][same]], start[order[1:][same]] - start[order[:-1][same]]
        band = (lag >= low) & (lag < 2 * low)
        places.append(here[band])
        lags.append(lag[band])
        again = np.zeros(len(start), bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        start, end, salt = start[again], end[again], salt[again]
    return np.concatenate(places), np.concatenate(lags)


def stretch(hashes: np.ndarray, place: int, lag: int, low: int, high: int) -> tuple[int, int]:
    """The longest ``[a, b)`` around ``place`` in which every word equals the one ``lag`` further; words lie in ``[low, high)``."""
    a, b, step = place, place, _STEP
    while b + lag < high:
        stop = min(b + step, high - lag)
        bad = np.flatnonzero(hashes[b:stop] != hashes[b + lag : stop + lag])
        if len(bad):
            b += int(bad[0])
            break
        b, step = stop, 2 * step
    step = _STEP
    while a > low:
        stop = max(a - step, low)
        bad = np.flatnonzero(hashes[stop:a] != hashes[stop + lag : a + lag])
        if len(bad):
            a = stop + int(bad[-1]) + 1
            break
        a, step = stop, 2 * step
    return a, b


def runs_of(hashes: np.ndarray, first: np.ndarray, least: int = LEAST, power: int = POWER) -> np.ndarray:
    """``(text, start, length, period)`` of every run, by text, start and period; starts are counted within the text."""
    places, lags = seed_pairs(hashes, first, least, power)
    order = np.lexsort((places, lags))
    places, lags = places[order], lags[order]
    cuts = np.flatnonzero(np.diff(lags, prepend=0, append=0)) if len(lags) else np.zeros(1, np.int64)
    found = []
    for begin, stop in zip(cuts[:-1], cuts[1:], strict=True):
        own, lag, i = places[begin:stop], int(lags[begin]), 0
        while i < len(own):
            text = int(np.searchsorted(first, own[i], "right")) - 1
            a, b = stretch(hashes, int(own[i]), lag, int(first[text]), int(first[text + 1]))
            if b - a + lag >= max(least, power * lag):
                found.append((text, a - int(first[text]), b - a + lag, lag))
            i = max(i + 1, int(np.searchsorted(own, b)))
    out = np.array(found, np.int64).reshape(-1, 4)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def dropped(runs: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each word, whether a run holds it behind that run's first period."""
    edge = np.zeros(int(first[-1]) + 1, np.int64)
    origin = first[runs[:, 0]] + runs[:, 1]
    np.add.at(edge, origin + runs[:, 3], 1)
    np.add.at(edge, origin + runs[:, 2], -1)
    return np.cumsum(edge[:-1]) > 0


def periodic_runs(docs: DataFrame, least: int = LEAST, power: int = POWER) -> DataFrame:
    """``doc_id, n_words, runs, collapsed``: every run of each text, and the text with its runs cut to one period.

    A run is a stretch of words with smallest period ``period``, of at least ``least`` words and ``power`` periods
    (three or more), that no neighbouring word extends. Runs come by start, then period. ``collapsed`` holds the words that stay,
    joined by one space; a word goes if any run contains it after that run's first period. A null or empty text
    has no words, no runs and an empty ``collapsed``. Rows are judged one by one, so null and repeated ids, ties
    and repeated rows change nothing. Empty tables give no row; only ``doc_id`` and ``text`` are read. Words are told apart by 64-bit hashes.
    """
    if power < 3 or least < 2:  # seeds are as long as their lag from three periods on
        raise ValueError(f"a run has two words and three periods at least: {least}, {power}")
    small_batches(docs.sparkSession)
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield judged(batch)
            release()

    def judged(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = W.split(batch.column(1))
        runs = runs_of(W.word_hashes(words), words.first, least, power)
        goes = dropped(runs, words.first)
        held = np.zeros(batch.num_rows, bool)
        held[runs[:, 0]] = True
        raw, kept = words.data.tobytes(), []
        for i in range(batch.num_rows):
            own = raw[words.offsets[i] : words.offsets[i + 1]].split()
            if held[i]:
                own = [w for w, out in zip(own, goes[words.first[i] : words.first[i + 1]].tolist(), strict=True) if not out]
            kept.append(b" ".join(own))
        bounds = pa.array(np.searchsorted(runs[:, 0], np.arange(batch.num_rows + 1)), pa.int32())
        parts = pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in (1, 2, 3)], fields=list(kind.value_type))
        columns = [batch.column(0), pa.array(words.counts, pa.int64()), pa.ListArray.from_arrays(bounds, parts, type=kind), pa.array(kept, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    return id_and_text(docs).mapInArrow(find, f"doc_id long, n_words long, runs {RUN}, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length over period; the first of equals. Null without runs."""
    first = F.get(runs, F.lit(0))
    return F.aggregate(runs, first, lambda best, x: F.when(x["length"] * best["period"] > best["length"] * x["period"], x).otherwise(best))


def digests(found: DataFrame) -> DataFrame:
    """Runs as digest columns: the strongest run, and hashes of all runs and of the collapsed text."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    best = found.withColumn("_best", strongest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"_best.{name}").alias(name) for name in ("start", "length", "period")],
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, where the texts of about a tenth of the documents end in a repeated stretch.

    With ``h`` the crc32 of the decimal id, ``n`` the number of words and ``g = h div 10``: where ``h % 10 = 0``, each word from ``a = g % n``
    on becomes word ``a + (i - a) % p`` with ``p = 1 + (n - a) div (3 + g % 8)``. Rows without an id or words stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = id_and_text(docs).withColumn("h", h).withColumn("w", F.when(F.col("h") % 10 == 0, words))
    sized = cut.withColumn("n", F.size("w").cast("long")).withColumn("g", F.floor(F.col("h") / 10)).withColumn("a", F.try_mod("g", "n"))
    shaped = sized.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    at = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + F.try_mod(i - F.col("a"), F.col("p"))))
    moved = F.array_join(F.transform(at, lambda i: F.get("w", i.cast("int"))), " ")
    return shaped.select("doc_id", F.when(F.col("n") > 0, moved).otherwise(F.col("text")).alias("text"))
