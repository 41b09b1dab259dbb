from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from devfold.llm import encode, pack, repair
from devfold.llm import words as W
from devfold.llm.common import ranges_of

from .conftest import many_rows, messy_rows, ordered, table, words

ENCODER = encode.encoder(encode.vocabulary())


def plain(text):
    return ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aZé ñß.,'!́ \n\t9½<|>ΣİÀ漢")), max_size=25), max_size=6))
def test_encoding_equals_the_library(texts):
    ids, bounds = ENCODER.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [plain(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=6))
def test_words(texts):
    split = W.split(pa.array(texts, pa.string()))
    raw = split.data.tobytes()
    got = [raw[a:b] for a, b in zip(split.start, split.end)]
    assert got == [w for t in texts for w in words(t)]
    assert split.counts.tolist() == [len(words(t)) for t in texts]
    hashes = W.word_hashes(split).tolist()
    assert len(set(hashes)) == len(set(got)) == len({*zip(got, hashes)})


@pytest.mark.parametrize("kinds", [1, 2, 3, 40])
@pytest.mark.parametrize("size", [0, 1, 2, 3, 7, 500, 40_000])
def test_pair_replacement_round_trip(kinds, size):
    rng = np.random.default_rng(size + kinds)
    ids = rng.integers(0, kinds, size).astype(np.uint32)
    ids[size // 3 : size // 2] = 0
    rules, sizes, seq = repair.compress(ids, 100)
    shard = repair.Shard.unpack(repair.Shard(np.zeros(1), np.zeros(1), np.array([size]), 100, rules, sizes, seq).pack())
    assert (shard.decode() == ids).all()
    for a, b in [(0, size), (size // 4, size // 2), (size // 2, size // 2), (max(0, size - 1), size)]:
        assert (shard.decode(a, b) == ids[a:b]).all()
    flat, bounds = shard.expansions()
    assert np.diff(bounds).tolist() == sizes.tolist()
    if size == 40_000 and kinds < 4:
        assert len(seq) < size / 3


def test_files(spark, messy, tmp_path):
    got = repair.token_files(messy, str(tmp_path / "f"), shard_bytes=30_000)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    at, want = 0, []
    for key, text, *_ in ordered(messy_rows()):
        ids = [*plain(text), 2]
        want.append((key, at, len(ids), crc(ids)))
        at += len(ids)
    rows = sorted((tuple(r) for r in got.collect()), key=lambda r: r[1])
    assert rows == want
    # any range of a shard can be read alone
    first = spark.read.parquet(str(tmp_path / "f")).orderBy("shard").first()
    shard = repair.Shard.unpack(bytes(first["payload"]))
    whole = shard.decode()
    assert len(whole) == first["tokens"] and (shard.decode(5, 9) == whole[5:9]).all()


def test_packing(messy):
    rows = [tuple(r) for r in pack.pack(messy, capacity=256).collect()]
    ids = {}
    for key, text, *_ in messy_rows():
        ids.setdefault(key, []).append([*plain(text), 2])
    want = sorted((str(k), a, len(x[a : a + 256]), crc(x[a : a + 256]), len(x)) for k, all_ in ids.items() for x in all_ for a in range(0, len(x), 256))
    assert sorted((str(k), a, n, c, t) for k, a, n, c, t, _, _ in rows) == want
    sequences = {}
    for *_, length, _, _, seq, off in [(r[0], r[1], r[2], r[3], r[4], r[5], r[6]) for r in rows]:
        sequences.setdefault(seq, []).append((off, length))
    for parts in sequences.values():
        ends = 0
        for off, length in sorted(parts):
            assert off == ends
            ends += length
        assert ends <= 256
    assert sorted(sequences) == list(range(len(sequences)))
    total = sum(r[2] for r in rows)
    assert len(sequences) <= -(-total // 256) * 1.1 + 1


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=20))
def test_patterns_use_every_piece_once(histogram):
    patterns = pack.shortest_pack_first(histogram, 64)
    used = {}
    for pattern, count in patterns:
        assert sum(a * b for a, b in pattern) <= 64
        for length, times in pattern:
            used[length] = used.get(length, 0) + times * count
    assert used == histogram


def test_empty_tables(empty, tmp_path):
    assert repair.token_files(empty, str(tmp_path / "f")).collect() == []
    assert pack.pack(empty).collect() == []


def test_rules_go_on_while_a_pair_repeats():
    rng = np.random.default_rng(3)
    passage = rng.integers(0, 30_000, 5000)
    ids = np.concatenate([np.concatenate([passage, rng.integers(0, 30_000, 50)]) for _ in range(8)]).astype(np.uint32)
    rules, sizes, seq = repair.compress(ids, 30_000)
    assert sizes.max() > 256 and len(seq) < 1000
    for some in (ids, rng.integers(0, 40, 30_000).astype(np.uint32), np.zeros(5000, np.uint32)):
        rules, sizes, seq = repair.compress(some, 30_000)
        _, uses = np.unique(np.stack([seq[:-1], seq[1:]], 1), axis=0, return_counts=True)
        assert uses.max(initial=0) < repair.LEAST_USES
        shard = repair.Shard(np.zeros(1), np.zeros(1), np.array([len(some)]), 30_000, rules, sizes, seq)
        assert (repair.Shard.unpack(shard.pack()).decode() == some).all()


def test_words_that_share_a_slot(monkeypatch):
    """Words that push each other out of the slots of words seen last still get their own ids, before and after the table starts again."""
    monkeypatch.setattr(encode, "NEAR_BITS", 2)
    monkeypatch.setattr(encode, "KEPT_WORDS", 30)
    own = encode.Encoder(encode.vocabulary())
    rng = random.Random(2)
    for _ in range(4):
        texts = [" ".join(rng.choice(["the", "of", "Über", "x", "x,", "漢字", "...", f"v{rng.randrange(40)}.", f"w{rng.randrange(9)}"]) for _ in range(rng.randrange(60))) for _ in range(9)]
        ids, bounds = own.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [plain(t) for t in texts]


def test_more_than_a_thousand_ranges(spark):
    rows = many_rows()
    cuts, size = ranges_of(table(spark, rows), 100)
    assert size == sum(len(r[1]) for r in rows)
    assert 1000 < len(cuts) < -(-size // 100) and cuts == sorted(set(cuts))
    keys = np.array([k if k is not None else -1 for k, *_ in rows])
    assert np.bincount(np.searchsorted(cuts, keys)).max() <= 12


def test_files_of_more_than_a_thousand_shards(spark, tmp_path):
    rows, path = many_rows(), str(tmp_path / "shards")
    got = repair.token_files(table(spark, rows), path, shard_bytes=60).collect()
    assert spark.read.parquet(path).count() > 1000
    want = {}
    for key, text, *_ in rows:
        want.setdefault(key, []).append(crc(plain(text) + [repair.END_ID]))
    found = {}
    for r in sorted(got, key=lambda r: r["start"]):
        found.setdefault(r["doc_id"], []).append(r["ids_crc32"])
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
