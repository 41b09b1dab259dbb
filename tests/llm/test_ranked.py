from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np

from devfold.llm import ranked

from .conftest import ITEM, NEAR, messy_rows, table

_TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in _TERM.findall(text or "")]


def plain(docs, items, top):
    """Every document scored for every item."""
    held = [(i, Counter(t)) for i, t in ((r[0], terms(r[1])) for r in docs) if t]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c in held:
            m = 25 + 75 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, k, d, -s) for k, (s, _, _, d) in enumerate(sorted(scored)[:top], 1)]
    return out


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "item_id long, text string, score string, doc_id long")


ITEMS = [
    (1, ITEM), (2, NEAR), (3, "the of the and The THE w5 w5"), (4, None), (5, ""), (6, " - . "), (7, "é ñ 漢字 <|endoftext|>"),
    (8, "nothing at1all lik3 this zz9"), (9, " ".join(f"v{i}" for i in range(0, 400, 3))), (None, "one two"), (10, "one two"), (10, "two w7 w7"),
    (11, "me.x@ex-a.example.com 4111"), (12, " ".join(f"v{i} the of" for i in range(150))),
]


def same(got, wanted):
    assert sorted(map(str, got)) == sorted(map(str, wanted))


def test_against_plain(spark, messy):
    got = ranked.ranked(messy.repartition(5), items_of(spark, ITEMS))
    same((tuple(r) for r in got.collect()), plain(messy_rows(), ITEMS, 10))


def test_blocks_of_items_and_ties(spark):
    rng = random.Random(8)
    rows = [(rng.choice([None, i, i // 3]), " ".join(rng.choice("abcdefgh") for _ in range(rng.choice([4, 4, 9]))), "en", "s", 1) for i in range(600)]
    items = [(i, " ".join(rng.choice("abcdefghxy") for _ in range(rng.randrange(1, 7)))) for i in range(20)]
    docs = table(spark, rows).repartition(4)
    for size in (1 << 20, 16):
        same((tuple(r) for r in ranked.ranked(docs, items_of(spark, items), top=7, block_bytes=size).collect()), plain(rows, items, 7))


def test_a_list_that_fills_batch_by_batch(spark):
    """Thresholds carried from batch to batch leave out nothing, whichever order the batches have."""
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"k{int(x)}" for x in rng.zipf(1.4, 12).clip(1, 300)), "en", "s", 1) for i in range(1500)]
    items = [(i, " ".join(f"k{int(x)}" for x in rng.integers(1, 40, 12))) for i in range(15)]
    docs = table(spark, rows).coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    found = ranked.ranked(docs, items_of(spark, items))
    same((tuple(r) for r in found.collect()), plain(rows, items, 10))


def test_edges(spark, messy, empty):
    columns = ["item_id", "rank", "doc_id", "score"]
    for docs, items in ((empty, ITEMS), (messy, []), (empty, []), (messy, [(1, None)]), (table(spark, [(1, None, "en", "s", 1)]), ITEMS)):
        got = ranked.ranked(docs, items_of(spark, items))
        assert got.columns == columns and got.count() == 0
    once = ranked.ranked(messy, items_of(spark, [(1, ITEM), (1, ITEM)]))
    same((tuple(r) for r in once.collect()), plain(messy_rows(), [(1, ITEM)], 10))
