from __future__ import annotations

import random

import pytest

LONG = " ".join(f"w{i % 977}" for i in range(60_000))
NEAR = " ".join(f"t{i}" for i in range(80))
ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa"


def table(spark, rows, extra=True):
    """Documents, with extra columns whose names the operators use inside."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    if extra:
        schema += ", range string, bucket string, component string, label string, spans string, _rank string, shard string, kind string"
        rows = [(*r, *["x"] * 8) for r in rows]
    return spark.createDataFrame(rows, schema)


def messy_rows():
    rng = random.Random(5)
    common = "the of and to in a is that for it".split()
    rows = [
        (1, None, "en", "s", None),
        (2, "", None, None, 0),
        (3, " \t\n\r\x0b\x0c ", "en", "s", 7),
        (4, "one", "fr", "s", 3),
        (5, "One TWO", "fr", "s", 7),
        (6, "one two", "de", "s", 7),
        (7, LONG, "en", "s", len(LONG)),
        (8, "x" * 300_000, "en", "s", 300_000),
        (9, "é ñ ß 漢字 😀   <|endoftext|> a<|b", "xx", "s", 3),
        (10, NEAR, "en", "s", 1),
        (11, NEAR + " extra", "en", "s", 1),
        (12, NEAR.upper(), "en", "s", 1),
        (12, NEAR.upper(), "en", "s", 1),
        (13, "other text under the same id", "en", "s", 1),
        (13, "and one more text under it", "en", "s", 1),
        (None, NEAR, "en", "s", 1),
        (None, None, None, None, None),
        (14, f"before {ITEM} after and so on", "en", "s", 1),
        (15, ("same line here\n" * 30), "en", "s", 1),
        (-5, "mail me.x@ex-a.example.com or 10.0.0.1 or 999.1.1.1 call +1 (555) 010-9999 card 4111 1111 1111 1111 end", "en", "s", 1),
    ]
    for i in range(20, 80):
        rows.append((i, " ".join(rng.choice(common) if rng.random() < 0.5 else f"v{rng.randrange(400)}" for _ in range(rng.randrange(1, 120))), rng.choice(["en", "de", "zz", None]), "s", 1))
    passage = " ".join(f"p{i}" for i in range(60))
    for i in range(80, 90):
        rows.append((i, f"start{i} {passage} end{i} tail{i}", "en", "s", 1))
    return rows


def many_rows(number=2400):
    """Short texts with null and repeated ids, in which ranges of 100 bytes are more than a thousand."""
    line = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    keys = [None if i % 400 == 7 else i // 2 if i % 100 == 3 else i for i in range(number)]
    return [(k, f"w{i % 60} {line} {i % 60}" + " tail" * (i % 3), "en", "s", 1) for i, k in enumerate(keys)]


@pytest.fixture(scope="session")
def messy(spark):
    return table(spark, messy_rows())


@pytest.fixture(scope="session")
def empty(spark):
    return table(spark, [])


def words(text):
    return (text or "").encode().split()


def lowered(text):
    return [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words(text)]


def ordered(rows):
    """Rows by id, nulls first, then by text."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
