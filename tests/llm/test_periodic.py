from __future__ import annotations

import hashlib
import random
import zlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from devfold.llm import periodic
from devfold.llm import words as W

from .conftest import messy_rows, table, words


def smallest(w):
    return next((d for d in range(1, len(w)) if w[d:] == w[:-d]), len(w))


def plain(w, least=6, power=4):
    """All runs by looking along every diagonal."""
    out = []
    for q in range(1, len(w) // power + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, power * q) and smallest(w[i : j + q]) == q:
                out.append((i, j - i + q, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def tailed(doc_id, w):
    if doc_id is None or not w:
        return w
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(x for i, x in enumerate(w) if i not in gone)


def digest(doc_id, w):
    runs = plain(w)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(w, runs)).hexdigest())


def by_text(rows):
    return sorted(map(str, rows))


def short(rows):
    """Rows that brute force can read."""
    return [r for r in rows if len(words(r[1])) < 5000]


def test_query_against_plain(spark, messy):
    rows = short(messy_rows()) + [(i, " ".join("ab"[(i >> j) & 1] for j in range(8)) * 9, "en", "s", 1) for i in range(100, 160)]
    docs = table(spark, rows)
    got = periodic.digests(periodic.periodic_runs(periodic.with_periodic_tails(docs))).collect()
    assert by_text(tuple(r) for r in got) == by_text(digest(r[0], tailed(r[0], words(r[1]))) for r in rows)


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = periodic.digests(periodic.periodic_runs(periodic.with_periodic_tails(docs))).collect()
    rows = [r for r in docs.select("doc_id", "text").collect() if len(words(r[1])) < 1200]
    wanted = {r[0]: digest(r[0], tailed(r[0], words(r[1]))) for r in rows}
    assert [r for r in map(tuple, got) if r[0] in wanted and r != wanted[r[0]]] == []
    assert sum(r[1] > 0 for r in got) > 5


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.tuples(st.text("abc", min_size=1, max_size=9), st.sampled_from([1, 1, 3, 4, 5, 9])), max_size=5), max_size=4), st.sampled_from([(6, 4), (2, 3), (20, 4), (9, 5)]))
def test_runs_of_repeated_pieces(parts, limits):
    texts = [[c for piece, n in text for c in piece * n] for text in parts]
    cut = W.split(pa.array([" ".join(t) for t in texts], pa.string()))
    got = periodic.runs_of(W.word_hashes(cut), cut.first, *limits)
    assert [tuple(r) for r in got.tolist()] == [(i, *r) for i, t in enumerate(texts) for r in plain(t, *limits)]


def test_period_whose_pieces_repeat_inside():
    """Every short seed of this period occurs several times in it, so only seeds as long as the lag find it."""
    rng = random.Random(3)
    for _ in range(200):
        root = "".join(rng.choice("ab") for _ in range(rng.randrange(30, 90)))
        w = list("c" + root * 4 + root[: rng.randrange(20)] + "d")
        cut = W.split(pa.array([" ".join(w)]))
        assert [tuple(r)[1:] for r in periodic.runs_of(W.word_hashes(cut), cut.first).tolist()] == plain(w)


def test_one_text_of_one_word(spark):
    docs = table(spark, [(1, "na " * 50_000, "en", "s", 1), (2, "x y " * 40_000, "en", "s", 1)])
    got = {r.doc_id: r for r in periodic.periodic_runs(docs).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 50_000, 1)] and got[1].collapsed == "na"
    assert [tuple(x) for x in got[2].runs] == [(0, 80_000, 2)] and got[2].collapsed == "x y"


def test_edges(spark, empty):
    assert periodic.digests(periodic.periodic_runs(empty)).count() == 0
    assert periodic.with_periodic_tails(empty).count() == 0
    got = periodic.periodic_runs(table(spark, [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "a a a a a a", "en", "s", 0)])).collect()
    assert sorted((r.doc_id is None, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got) == [(False, 0, [], ""), (False, 6, [(0, 6, 1)], "a"), (True, 0, [], "")]
    with pytest.raises(ValueError):
        periodic.periodic_runs(empty, power=2)
