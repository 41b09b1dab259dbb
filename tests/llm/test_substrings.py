from __future__ import annotations

import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from devfold.llm import substrings

from .conftest import many_rows, messy_rows, ordered, table, words


def plain(rows, width):
    """Words each row loses, by comparing window texts in order."""
    seen, out = set(), []
    for key, text, *_ in ordered(rows):
        own = words(text)
        gone = set()
        for i in range(len(own) - width + 1):
            window = tuple(own[i : i + width])
            if window in seen:
                gone.update(range(i, i + width))
            seen.add(window)
        kept = b" ".join(w for i, w in enumerate(own) if i not in gone)
        out.append((key, len(own), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def by_text(rows):
    return sorted(map(str, rows))


def test_against_plain(messy):
    got = substrings.removals(messy, range_bytes=20_000)
    assert by_text(tuple(r) for r in got.collect()) == by_text(plain(messy_rows(), 20))


def test_short_windows_and_hot_passage(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(30))) + " hot line of words that many share", "en", "s", 1) for i in range(300)]
    docs = table(spark, rows)
    got = substrings.removals(docs, width=4, range_bytes=500)
    assert by_text(tuple(r) for r in got.collect()) == by_text(plain(rows, 4))


def test_more_than_a_thousand_ranges(spark):
    got = substrings.removals(table(spark, many_rows()), range_bytes=100)
    assert by_text(tuple(r) for r in got.collect()) == by_text(plain(many_rows(), 20))


def test_spans_and_kept_text(spark):
    docs = table(spark, [(1, "a b c d e", "en", "s", 1), (2, "x a b c  y\nc d e z", "en", "s", 1)])
    rows = {r["doc_id"]: (r["spans"], r["kept"]) for r in substrings.removals(docs, width=3, output="text").collect()}
    assert rows == {1: ("", "a b c d e"), 2: ("1:4,5:8", "x y z")}


def test_empty(empty):
    assert substrings.removals(empty).collect() == []


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=50, unique=True))
def test_squeezed_keys(keys):
    keys = np.array(sorted(keys), np.uint64)
    assert substrings.unsqueeze(substrings.squeeze(keys)).tolist() == keys.tolist()
