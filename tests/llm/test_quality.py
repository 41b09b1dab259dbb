from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
import pytest

from devfold.llm import encode, quality

from .conftest import messy_rows, table


def plain(text, lang, tokenizer, pieces):
    text = text or ""
    own = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(own[i : i + 3]) for i in range(len(own) - 2))
    covered = {j for i in range(len(own) - 2) if seen[tuple(own[i : i + 3])] > 1 for j in range(i, i + 3)}
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    counts = Counter(ids)
    entropy = abs(sum(c / len(ids) * math.log2(c / len(ids)) for c in counts.values())) if ids else 0.0
    flat = [i for w in own for i in pieces.encode(w)]
    fallback = sum(pieces.is_byte(i) for i in flat) / max(1, len(flat))
    chars = sum(map(len, own))
    failed = len(own) < 50 or 100 * len(covered) > 50 * len(own)
    letters = [c for c in text if c.isalpha()]
    latin = sum(ord(c) < 0x280 for c in letters)
    other = quality.LATIN if 2 * latin >= len(letters) else quality.WIDEST
    band = quality.BANDS.get((lang or "").split("-")[0].lower(), other)
    per = chars / max(1, len(ids))
    kept = not failed and band.chars_per_token[0] <= per <= band.chars_per_token[1] and fallback <= band.most_fallback and entropy >= band.floor(len(ids))
    return (len(own), chars, sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed, kept, round(per, 9), round(fallback, 9), round(entropy, 9))


@pytest.fixture(scope="module")
def files():
    import sentencepiece

    return encode.encoder(encode.vocabulary()).tokenizer, sentencepiece.SentencePieceProcessor(model_file=encode.vocabulary("piece_bpe_32k.model"))


def test_against_plain(messy, files):
    got = quality.judged(messy).collect()
    want = sorted(str((r[0], *plain(r[1], r[2], *files))) for r in messy_rows())
    assert sorted(str((*tuple(r)[:8], *(round(x, 9) for x in tuple(r)[8:]))) for r in got) == want


def test_kept_rows_keep_their_columns(messy, files):
    got = quality.kept(messy)
    assert got.columns == messy.columns
    want = sorted(str(r[0]) for r in messy_rows() if plain(r[1], r[2], *files)[6])
    assert sorted(str(r["doc_id"]) for r in got.collect()) == want


def test_without_languages_and_empty(spark, messy, empty):
    assert quality.judged(messy.drop("lang")).count() == len(messy_rows())
    assert quality.judged(empty).collect() == [] and quality.kept(empty).collect() == []


def test_held_out_labels(spark):
    """Bands were set on sf0.1; here they judge the labelled documents of another table."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = quality.judged(spark.read.parquet(f"{folder}/documents.parquet")).where("NOT base_failed").join(labels, "doc_id").collect()
    good, bad = [r["kept"] for r in rows if r["quality"] == 1], [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.995 * len(good) and sum(bad) <= 0.15 * len(bad)


def test_bands_by_tag_and_script(spark):
    """Junk that the band of its language rejects is rejected under a longer tag, an unknown one and none."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    shares = {}
    for name, lang in (("own", "lang"), ("long", "concat(upper(lang), '-XX')"), ("unknown", "'pt'"), ("none", "cast(null as string)")):
        rows = quality.judged(docs.selectExpr("doc_id", "text", f"{lang} AS lang")).where("NOT base_failed").join(labels, "doc_id").collect()
        shares[name] = [sum(r["kept"] for r in rows if r["quality"] == q) / sum(r["quality"] == q for r in rows) for q in (0, 1)]
    assert shares["own"] == shares["long"] and shares["unknown"] == shares["none"]
    assert shares["unknown"][1] >= 0.995 and shares["unknown"][0] < 0.6
    greek = " ".join(f"λέξη{'αβγδεζηθ'[i % 8]}{'ικλμν'[i % 5]}" for i in range(80))
    assert quality.band_of("el", -1, quality.BANDS, quality.WIDEST) is quality.WIDEST
    assert quality.measures(pa.array([greek, "latin words", "", "123 漢字"]), *quality._files(None, None))["script"].tolist() == [-480, 10, 0, -2]


def test_repeats_in_one_row_do_not_touch_another(spark):
    docs = table(spark, [(1, "a b c", "en", "s", 1), (2, "a b c", "en", "s", 1), (3, "a b c d a b c", "en", "s", 1)])
    assert sorted((r["doc_id"], r["n_repeat_words"]) for r in quality.judged(docs).collect()) == [(1, 0), (2, 0), (3, 6)]
