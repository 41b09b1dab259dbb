from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from devfold.llm import jaccard, trie
from devfold.llm.components import components

from .conftest import NEAR, lowered, messy_rows, table


def shingles(text, width=3):
    own = lowered(text)
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + width]) for i in range(len(own) - width + 1)) or frozenset([tuple(own)])


def grouped(sets, share):
    """Smallest id of each id's component; sets are (id, set) and may repeat an id."""
    up = {}
    find = lambda x: x if up.setdefault(x, x) == x else find(up[x])
    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= share * len(s | t):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return lambda x: None if x is None else find(x)


def plain(rows, share=90):
    sets = [(r[0], shingles(r[1])) for r in rows]
    root = grouped(sets, share)
    return sorted(str((a, len(s), root(a))) for a, s in sets)


def near_rows(seed, size=120):
    """Chains of near copies: each changes a word or two of an earlier one."""
    rng = random.Random(seed)
    texts = [[f"s{seed}w{rng.randrange(500)}" for _ in range(rng.choice([4, 12, 40, 90, 150]))] for _ in range(6)]
    while len(texts) < size:
        own = list(rng.choice(texts))
        for _ in range(rng.choice([0, 1, 1, 2, 5])):
            own[rng.randrange(len(own))] = f"n{rng.randrange(10_000)}"
        texts.append(own)
    ids = rng.sample(range(10_000), size)
    return [(i, " ".join(t), "en", "s", 1) for i, t in zip(ids, texts)]


def test_against_plain(messy):
    got = jaccard.jaccard_components(messy).collect()
    assert sorted(str(tuple(r)) for r in got) == plain(messy_rows())


@pytest.mark.parametrize("block", [4 << 20, 3000])
def test_near_copies_and_split_blocks(spark, block):
    rows = near_rows(1) + [(20_000 + r[0], r[1], *r[2:]) for r in near_rows(1)[:40]]
    rows = [*rows, *((30_000 + i, "hot copy of one text that many rows hold in full", "en", "s", 1) for i in range(200))]
    got = jaccard.jaccard_components(table(spark, rows), block_bytes=block).collect()
    assert sorted(str(tuple(r)) for r in got) == plain(rows)


def test_wider_shingles_and_a_lower_share(spark):
    rows = near_rows(3)
    got = jaccard.jaccard_components(table(spark, rows), width=5, share=80).collect()
    sets = [(r[0], shingles(r[1], 5)) for r in rows]
    root = grouped(sets, 80)
    assert sorted(str(tuple(r)) for r in got) == sorted(str((a, len(s), root(a))) for a, s in sets)


def test_split_component_that_representatives_do_not_join(spark):
    """A chain: neighbours link, ends do not, and every part holds some of it."""
    base = [f"c{i}" for i in range(120)]
    rows = []
    for step in range(40):
        own = list(base)
        own[: 2 * step] = [f"d{i}" for i in range(2 * step)]
        rows.append((step, " ".join(own), "en", "s", 1))
    for block in (1 << 20, 2500):
        got = jaccard.jaccard_components(table(spark, rows), block_bytes=block).collect()
        assert sorted(str(tuple(r)) for r in got) == plain(rows)


def test_one_of_each(spark, messy):
    """Of every component of different rows one stays; that with the smallest id where all ids are known and differ."""
    rows = messy_rows() + [(None, NEAR, "de", "t", 2), (None, "alone without an id", "en", "s", 1), (200, NEAR + " more", "en", "s", 1)]
    nodes = sorted({(r[0], r[1] or "") for r in rows}, key=str)
    root = grouped([(i, shingles(t)) for i, (_, t) in enumerate(nodes)], 90)
    groups = {}
    for i, node in enumerate(nodes):
        groups.setdefault(root(i), []).append(node)
    docs = table(spark, rows)
    kept = [(r["doc_id"], r["text"] or "") for r in jaccard.one_of_each(docs).collect()]
    assert len(kept) == len(groups)
    ids = [r[0] for r in rows]
    for group in groups.values():
        (stays,) = [node for node in kept if node in group]
        if all(i is not None and ids.count(i) == 1 for i, _ in group):
            assert stays[0] == min(i for i, _ in group)
    assert {(13, "other text under the same id"), (13, "and one more text under it")} <= set(kept)
    assert jaccard.one_of_each(docs).columns == docs.columns


def test_one_of_each_with_clashing_names(spark):
    rows = [(1, NEAR, 1, 2, 3, 4), (2, NEAR, 1, 2, 3, 4), (3, "short", 1, 2, 3, 4), (3, "other", 1, 2, 3, 4), (None, "x", 1, 2, 3, 4), (None, "x", 1, 2, 3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _at int, node int, Component int, _key int")
    got = jaccard.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted((str(r.doc_id), r.text, r.node) for r in got.collect()) == [("1", NEAR, 2), ("3", "other", 2), ("3", "short", 2), ("None", "x", 2)]
    unique = docs.where("doc_id < 3")
    assert [r.doc_id for r in jaccard.one_of_each(unique).collect()] == [1]


def test_empty(empty):
    assert jaccard.jaccard_components(empty).collect() == []
    assert jaccard.one_of_each(empty).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sets(st.integers(0, 25), max_size=24), max_size=25), st.integers(50, 100))
def test_tree_connects_what_links(sets, share):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    forest = trie.Forest(len(sets))
    for a, b in trie.links(arrays, share):
        assert 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b])
        forest.union(a, b)
    root = grouped(list(enumerate(sets)), share)
    assert [forest.find(i) for i in range(len(sets))] == [root(i) for i in range(len(sets))]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**6))
def test_linked_sets_share_a_signature(size, seed):
    rng = np.random.default_rng(seed)
    one = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
    cut = rng.integers(0, len(one) // 9 + 1)
    new = rng.integers(0, max(1, len(one) // 9 - cut + 1))
    two = np.unique(np.concatenate([rng.permutation(one)[cut:], rng.integers(0, 2**64, new, dtype=np.uint64)]))
    overlap = len(np.intersect1d(one, two))
    if 100 * overlap >= 90 * (len(one) + len(two) - overlap):
        keys, owner = jaccard.signatures(np.concatenate([one, two]), np.array([0, len(one), len(one) + len(two)]))
        assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 6000), st.integers(0, 10**6), st.sampled_from([80, 90]), st.sampled_from([0, 0.1, 0.6, 0.95, 1]), st.sampled_from([0, 0.5, 1]))
def test_linked_sets_share_a_signature_without_common_shingles(size, seed, share, ignored, lost):
    """Sets as unlike as a link allows, losing, swapping or gaining elements, with a part of all elements ignored."""
    rng = np.random.default_rng(seed)
    one = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
    unlike = int(len(one) * (100 - share) / (100 if lost == 1 else share if lost == 0 else (100 + share) / 2))
    cut = int(unlike * lost) if lost != 0.5 else int(len(one) * (100 - share) / (100 + share))
    new = unlike - cut if lost != 0.5 else cut
    two = np.unique(np.concatenate([rng.permutation(one)[cut:], rng.integers(0, 2**64, new, dtype=np.uint64)]))
    overlap = len(np.intersect1d(one, two))
    assert 100 * overlap >= share * (len(one) + len(two) - overlap)
    both = np.concatenate([one, two])
    rare = (both % np.uint64(100)) >= np.uint64(100 * ignored)
    keys, owner = jaccard.signatures(both, np.array([0, len(one), len(one) + len(two)]), share, rare)
    assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())


def test_large_sets_need_more_than_one_element_in_common():
    """Unlike sets that share single elements everywhere have no signature in common."""
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2**64, 5000, dtype=np.uint64)) for _ in range(2)]
    sets[1] = np.unique(np.concatenate([sets[1][:4750], rng.choice(sets[0], 250, replace=False)]))
    keys, owner = jaccard.signatures(np.concatenate(sets), np.cumsum([0, len(sets[0]), len(sets[1])]), 80)
    assert not set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())


@pytest.mark.parametrize("task", [1_000_000, 50])
@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, None)], [(i, i + 1) for i in range(300)], [(5, i) for i in range(6, 400)] + [(1000, 399), (2000, 2001)]])
def test_components(spark, edges, task):
    frame = spark.createDataFrame(edges, "src long, dst long")
    got = {r["node"]: r["component"] for r in components(frame, task).collect()}
    up = {}
    find = lambda x: x if up.setdefault(x, x) == x else find(up[x])
    for a, b in edges:
        if b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            up[y] = x
    assert got == {x: find(x) for x in list(up)}


def test_common_shingles_are_counted_in_all_documents(spark):
    """Of 9,000 documents, 18 make a shingle common and 17 do not; repeats in a document count once."""
    extra = {i: "in0 in1 in2" for i in range(0, 9000, 500)}
    extra |= {i: "not quite enough" for i in range(1, 17 * 500, 500)}
    extra |= {i: "twice over here twice over here" for i in range(2, 12 * 500, 500)}
    rows = [(i, f"a{i} b{i} {extra.get(i, '')}") for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = jaccard.common_shingles(docs, 1 << 20, 3)
    want, _ = jaccard.shingle_sets(pa.array(["in0 in1 in2"]), 3)
    assert got.tolist() == want.tolist()


def test_common_shingles_in_long_and_few_documents(spark, monkeypatch):
    """Runs cut short by the number of shingles report the same."""
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcdefg") for _ in range(rng.randrange(0, 40)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    held = {}
    for _, text in rows:
        for key in jaccard.shingle_sets(pa.array([text]), 3)[0].tolist():
            held[key] = held.get(key, 0) + 1
    want = sorted(k for k, n in held.items() if n >= 8)
    assert want and jaccard.common_shingles(docs, 1, 3).tolist() == want
    monkeypatch.setattr(jaccard, "RUN_SHINGLES", 50)
    assert jaccard.common_shingles(docs, 1, 3).tolist() == want


def test_near_copies_do_not_meet_in_every_bucket(spark, monkeypatch):
    """What few signatures connect makes no edge in the buckets of the others, however many there are."""
    rng = random.Random(5)
    texts = [[f"w{rng.randrange(10**6)}" for _ in range(400)] for _ in range(30)]
    rows = [(2 * i + j, " ".join([*text, f"end{j}"])) for i, text in enumerate(texts) for j in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    monkeypatch.setattr(jaccard, "BUCKET_BYTES", 1000)
    edges = jaccard.coarse(docs)
    assert {r["node"]: r["component"] for r in components(edges).collect()} == {i: i - i % 2 for i in range(60)}
    assert edges.count() <= 3 * 30


@pytest.mark.parametrize("texts", [300, 4096 + 300, 5 * 4096 + 1])
@pytest.mark.parametrize("piece", [512, 392])
def test_no_run_is_short_beside_others(texts, piece):
    """A run of few texts would report all its shingles, so the rest of a task joins the run before it."""
    sizes = [piece] * (texts // piece) + [texts % piece]
    got = list(jaccard.runs((np.full(3 * n, i, np.uint64), n) for i, n in enumerate(sizes)))
    assert sum(n for _, n in got) == texts
    assert np.concatenate([k for k, _ in got]).tolist() == np.repeat(np.arange(len(sizes)), 3 * np.array(sizes)).tolist()
    assert all(min(texts, 4096 - 512) <= n <= 2 * 4096 for _, n in got)
