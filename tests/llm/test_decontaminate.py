from __future__ import annotations

import random

from devfold.llm import decontaminate

from .conftest import ITEM, lowered, messy_rows, table


def shingles(text, width=5):
    own = lowered(text)
    if not own:
        return set()
    return {tuple(own[i : i + width]) for i in range(len(own) - width + 1)} or {tuple(own)}


def plain(rows, items):
    out = []
    for item, text, *_ in items:
        own = shingles(text)
        width = min(5, len(lowered(text)))
        for key, body, *_ in rows:
            words = lowered(body)
            there = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if width else set()
            shared = len(own & there)
            if own and 100 * shared >= 80 * len(own):
                out.append((key, item, len(own), shared, shared / len(own)))
    return sorted(map(str, out))


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string, range string")


def items_of(rng):
    items = [(1, ITEM, "x"), (2, "one two", "x"), (3, None, "x"), (4, "", "x"), (5, "beta", "x"), (6, ITEM + " lambda", "x"), (None, ITEM, "x"), (1, ITEM, "x")]
    return items + [(i, " ".join(f"b{rng.randrange(30)}" for _ in range(rng.choice([3, 6, 12, 40, 200]))), "x") for i in range(10, 40)]


def test_against_plain(spark, messy):
    rng = random.Random(3)
    items = items_of(rng)
    rows = messy_rows()
    for i, (_, text, _) in enumerate(items[8:]):
        own = text.split()
        own[rng.randrange(len(own))] = "changed"
        rows.append((200 + i, "filler words " * rng.randrange(300) + " ".join(own) + " tail" * rng.randrange(300), "en", "s", 1))
    docs, marks = table(spark, rows), bench(spark, items)
    want = plain(rows, items)
    assert len(want) > 20
    for block in (8 << 20, 400):
        got = decontaminate.contained(docs, marks, block_bytes=block).collect()
        assert sorted(str(tuple(r)) for r in got) == want
    hit = {eval(w)[0] for w in want}
    left = decontaminate.without_items(docs, marks, block_bytes=400)
    assert left.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(r[0]) for r in rows if r[0] not in hit)


def test_empty(spark, messy, empty):
    assert decontaminate.contained(empty, bench(spark, [(1, ITEM, "x")])).collect() == []
    assert decontaminate.contained(messy, bench(spark, [])).collect() == []
    assert decontaminate.without_items(messy, bench(spark, [])).count() == len(messy_rows())
