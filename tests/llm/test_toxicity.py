from __future__ import annotations

import random
import time
import zlib

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from devfold.llm import toxicity

from .conftest import LONG, messy_rows, table

BITS = 16


def grams(text):
    plain = f" {' '.join((text or '').lower().split())} "
    return {(n, plain[i : i + n]) for n in toxicity.SIZES for i in range(len(plain) - n + 1)}


def test_every_n_gram_is_seen_once_and_none_spans_two_texts():
    texts = ["Abc  abc", None, "", "x", "éñ漢字😀 y", "ab", "c" * 40, "Abc abc"]
    seen: dict[int, set[int]] = {}
    for text, bucket in toxicity.present(texts, 20):
        for t, b in zip(text.tolist(), bucket.tolist(), strict=True):
            assert b not in seen.setdefault(t, set())
            seen[t].add(b)
    for i, text in enumerate(texts):
        assert len(seen.get(i, ())) == len(grams(text)), text
    assert seen[0] == seen[7]


def test_pieces_do_not_change_buckets(monkeypatch):
    texts = [" ".join(f"w{random.Random(i).randrange(50)}" for _ in range(i)) for i in range(60)]
    whole = np.concatenate([np.stack(p) for p in toxicity.present(texts, 20)], axis=1)
    monkeypatch.setattr(toxicity, "PIECE", 100)
    cut = np.concatenate([np.stack(p) for p in toxicity.present(texts, 20)], axis=1)
    assert (whole == cut).all()


def sample(n, seed, bad=("loweient", "blarg", "scumble")):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        toxic = rng.random() < 0.25
        w = [f"{rng.choice('bdfgk')}{rng.choice('aeiou')}{rng.choice('lmnr')}{rng.choice('aeiou')}" for _ in range(rng.randrange(5, 80))]
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(bad) + rng.choice(["", "s", "ish", "."])
        rows.append((i, " ".join(w), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def learnt(spark):
    rows = sample(1500, 1)
    docs = table(spark, [(i, t, "en", "s", 1) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, 1, y, "x") for i, _, y in rows], "doc_id long, quality int, toxic int, text string")
    return rows, docs, labels


def test_held_out_accuracy(spark, learnt):
    rows, docs, labels = learnt
    got = {r.doc_id: r for r in toxicity.scored(docs, labels, bits=BITS).collect()}
    assert len(got) == len(rows)
    right = [got[i].predicted == y for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert 400 < len(right) < 600 and np.mean(right) > 0.97
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _, _ in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())


def test_held_out_labels_change_nothing(spark, learnt):
    """Scores depend on no label of a held-out row."""
    _, docs, labels = learnt
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = ({r.doc_id: round(r.score, 9) for r in toxicity.scored(docs, x, bits=BITS).collect()} for x in (labels, turned))
    assert one == two


def test_counts_against_plain(spark, learnt, monkeypatch):
    rows, docs, labels = learnt
    train = toxicity.labelled(docs, labels).repartition(6)
    monkeypatch.setattr(toxicity, "TASK_BYTES", 40_000)
    monkeypatch.setattr(toxicity, "FAN", 2)
    got = toxicity.bucket_counts(train, 14)
    wanted = np.zeros((2, 1 << 14), int)
    for _, text, y in rows:
        for _, bucket in toxicity.present([text], 14):
            wanted[y, bucket] += 1
    assert (got == wanted).all()


def test_ratios_and_vectors(spark):
    rows = [(i, t, y) for i, (t, y) in enumerate([("aaa", 1), ("aaa bbb", 1), ("bbb", 0), ("ccc", 0)])]
    docs = spark.createDataFrame([(t, float(y)) for _, t, y in rows], "text string, label double")
    counts = toxicity.bucket_counts(docs, 16)
    ratio = toxicity.ratios(counts, least_z=0.0)
    p = counts + 1.0
    assert np.allclose(ratio, np.log(p[1] / p[1].sum() * p[0].sum() / p[0]))
    (bucket,) = [b for _, b in toxicity.present(["aaa"], 16)]
    got = {tuple(r.features.indices) for r in toxicity.vectors(docs.where("text = 'aaa'"), np.where(np.isin(np.arange(1 << 16), bucket), ratio, 0)).collect()}
    assert got == {tuple(range(len(bucket)))}


def test_edges(spark, messy, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.scored(empty, none, bits=BITS).count() == 0
    assert {r.score for r in toxicity.scored(messy, none, bits=BITS).collect()} == {0.5}
    one = spark.createDataFrame([(7, 1, 0), (7, 1, 0), (None, 0, 1), (9999, 0, 1), (9, 0, None), (10, 0, 5)], "doc_id long, quality int, toxic int")
    got = toxicity.scored(messy, one, bits=BITS).collect()
    assert len(got) == len(messy_rows()) and {round(r.score, 6) for r in got} == {0.25}
    both = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(80)], "doc_id long, quality int, toxic int")
    got = toxicity.scored(messy, both, bits=BITS).collect()
    blank = {round(r.score, 12) for r in got if r.doc_id in (1, 2, 3)}
    assert len(got) == len(messy_rows()) and len(blank) == 1
    long = [r.score for r in got if r.doc_id == 7]
    assert len(long) == 1 and len(LONG) > 200_000


def test_distinct_buckets_cost_little_more_than_a_sort():
    """Finding the distinct buckets of texts takes less than six times as long as sorting as many keys."""
    rng = np.random.default_rng(1)
    texts = ["".join(map(chr, rng.integers(97, 123, 2000))) for _ in range(250)]
    keys = np.sort(np.repeat(np.arange(250), 6000)) << 20 | rng.integers(0, 1 << 20, 250 * 6000)

    def least(run):
        took = []
        for _ in range(5):
            start = time.process_time()
            run()
            took.append(time.process_time() - start)
        return min(took)

    assert least(lambda: list(toxicity.present(texts, 20))) < 6 * least(lambda: np.sort(keys))


def test_fit_equals_the_library_and_keeps_no_rows(spark, monkeypatch):
    """Weights of Spark's regression over the whole vectors, from blocks that no executor holds on to."""
    rows = [("", 0.0), (None, 1.0), *((t, float(y)) for _, t, y in sample(700, 4))]
    train = spark.createDataFrame(rows, "text string, label double").repartition(5).localCheckpoint()
    counts = toxicity.bucket_counts(train, BITS)
    ratio = toxicity.ratios(counts, least_z=1.0)
    learner = LogisticRegression(maxIter=60, regParam=1e-4, elasticNetParam=0.0, standardization=False, tol=1e-6)
    wanted = learner.fit(toxicity.vectors(train, ratio))
    kept, search = set(spark.sparkContext._jsc.getPersistentRDDs()), toxicity.minimised

    def watched(cost, *more):
        def looked(point):
            out = cost(point)
            assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= kept
            return out

        return search(looked, *more)

    monkeypatch.setattr(toxicity, "minimised", watched)
    monkeypatch.setattr(toxicity, "BLOCK_TEXTS", 64)
    monkeypatch.setattr(toxicity, "STEP_CELLS", 20_000)
    monkeypatch.setattr(toxicity, "HELD_CELLS", 0)
    got = toxicity.fit(train, BITS, least_z=1.0)
    assert np.allclose(got.weights[ratio != 0], ratio[ratio != 0] * wanted.coefficients.toArray(), rtol=1e-2, atol=1e-4)
    assert abs(got.intercept - wanted.intercept) < 1e-3 and not got.weights[ratio == 0].any()


def test_blocks_hold_what_the_vectors_hold(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK_TEXTS", 10)
    texts = [None, "", "a", "", "", *(t for _, t, _ in sample(60, 5))]
    rows = spark.createDataFrame([(t, float(i % 2)) for i, t in enumerate(texts)], "text string, label double").coalesce(1)
    ratio = np.where(np.arange(1 << 18) % 3, 0.5, 0.0)
    wanted = [(r.label, r.features.indices.tolist()) for r in toxicity.vectors(rows, ratio).collect()]
    got = []
    for labels, sizes, steps, far in toxicity.slotted(rows, ratio).collect():
        label, size = np.frombuffer(labels, np.int8), np.frombuffer(sizes, np.int32)
        assert len(label) <= 10
        slots = np.split(toxicity.unslotted(steps, far, size, np.count_nonzero(ratio)), np.cumsum(size)[:-1])
        got += [(float(y), own.tolist()) for y, own in zip(label, slots)]
    assert got == wanted
