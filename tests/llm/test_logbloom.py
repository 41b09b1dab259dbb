from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from devfold.llm import logbloom

from .conftest import lowered, many_rows, messy_rows, table


def held_out(key):
    return zlib.crc32(b"" if key is None else str(key).encode()) % 5 == 1


def plain(rows):
    counts = Counter(t for key, text, *_ in rows if not held_out(key) for t in [*lowered(text), None])
    total, types = sum(counts.values()), len(counts)
    out = []
    for key, text, *_ in rows:
        own = [*lowered(text), None]
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (types + 1))) for t in own)
        out.append(str((key, held_out(key), len(own), sum(counts[t] > 0 for t in own), total, round(base, 6))))
    return sorted(out)


def test_base_and_blocks(messy):
    one = logbloom.score_texts(messy, range_bytes=30_000).collect()
    assert sorted(str((*tuple(r)[:5], round(r["base_score"], 6))) for r in one) == plain(messy_rows())
    many = logbloom.score_texts(messy, range_bytes=30_000, block_bytes=3000).collect()
    score = lambda rows: sorted((str(r["doc_id"]), r["n_tokens"], round(r["score"], 6)) for r in rows)
    assert score(one) == score(many)
    three = logbloom.score_texts(messy, order=3, range_bytes=30_000).collect()
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in one + three)


def test_more_than_a_thousand_ranges(spark):
    got = logbloom.score_texts(table(spark, many_rows()), range_bytes=100).collect()
    assert sorted(str((*tuple(r)[:5], round(r["base_score"], 6))) for r in got) == plain(many_rows())


def test_levels_never_fall_below_the_count_and_seldom_exceed_it(spark):
    rows = [(" ".join(f"w{i}" for i in range(k, 4000, k + 1)),) for k in range(12)] * 3
    train = spark.createDataFrame(rows, "text string")
    made, buckets = logbloom.gather(train, 2, 10_000)
    made = made.cache()
    (whole,) = logbloom.blocks(made, buckets, 1 << 30)
    keys, bounds = logbloom.tokens(pa.array([r[0] for r in rows]))
    for row in logbloom.grams(keys, bounds, 2):
        distinct, counts = np.unique(row, return_counts=True)
        want, got = logbloom.quantise(counts), whole.levels(distinct)
        assert (got >= want).all() and (got > want).mean() < 0.06
    unseen = whole.levels(np.random.default_rng(1).integers(0, 2**64, 20_000, dtype=np.uint64))
    assert (unseen > 0).mean() < 0.06
    parts = list(logbloom.blocks(made, buckets, 1))
    known = np.zeros(len(distinct), np.uint8)
    for part in parts:
        known = part.levels(distinct, known)
    assert len(parts) == buckets and (known == got).all()
    made.unpersist()


def test_held_out_texts_score_better_than_by_words_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = logbloom.score_texts(docs).where("held_out").collect()
    gain = [r["score"] - r["base_score"] for r in rows]
    assert sum(gain) > 0.05 * -sum(r["base_score"] for r in rows) and np.mean(np.array(gain) < 0) < 0.2


def test_probabilities_sum_to_one():
    """Over the vocabulary, after any history, with exact counts in place of the filter."""
    means = np.zeros((2, logbloom.MOST_LEVELS))
    means[:, 1:8] = np.arange(1, 8)
    pairs = {("a", "a"): 1, ("a", "b"): 3, ("b", "a"): 2}
    singles = {"a": 4, "b": 2, "c": 1}
    total, types = sum(singles.values()), len(singles)
    trust = np.full((2, logbloom.MOST_LEVELS), 0.6)
    model = logbloom.Model(total, types, means, trust, 0)
    for past in "ab":
        words = ["a", "b", "c", None]
        levels = np.array([[singles[past]] + [singles.get(w, 0) for w in words], [0] + [pairs.get((past, w), 0) for w in words]])
        before = np.array([-1, 0, 0, 0, 0])
        p = 10 ** model.score(levels, before)[1:]
        full = sum(n for (a, _), n in pairs.items() if a == past) / singles[past]
        lower = (sum(singles.values()) + 0.5 * 4) / (total + 0.5 * (types + 1))
        assert math.isclose(p.sum(), 0.6 * full + 0.4 * lower)


def test_empty(empty, messy):
    assert logbloom.score_texts(empty).collect() == []
    none = logbloom.score_texts(messy.where("doc_id = 1")).collect()
    assert [r["n_tokens"] for r in none] == [1]
