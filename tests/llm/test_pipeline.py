from __future__ import annotations

import re

import corpus_pipeline as P
from devfold.llm import encode, jaccard, pack, privacy, quality

from . import test_decontaminate, test_jaccard, test_quality, test_tokens
from .conftest import ITEM, NEAR, messy_rows, table


def rows_of(spark, tmp_path):
    filler = lambda k: " ".join(f"{k}{i}" for i in range(70))
    rows = messy_rows() + [(500, filler("g") + f" {ITEM} " + filler("h"), "zz", "s", 1), (501, filler("k") + " write to joe@example.org or 10.1.2.3", "zz", "s", 1), (502, filler("k") + " write to joe@example.org or 10.1.2.3", "zz", "s", 1)]
    rows = [r for r in rows if r[0] not in (12, 13)]
    docs = table(spark, rows, extra=False)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return rows


def test_stages_and_run(spark, tmp_path):
    import sentencepiece

    rows = rows_of(spark, tmp_path)
    files = encode.encoder(encode.vocabulary()).tokenizer, sentencepiece.SentencePieceProcessor(model_file=encode.vocabulary("piece_bpe_32k.model"))
    rows = [r for r in rows if test_quality.plain(r[1], r[2], *files)[6]]
    root = test_jaccard.grouped([(r[0], test_jaccard.shingles(r[1], 5)) for r in rows], 80)
    rows = [r for r in rows if root(r[0]) == r[0]]
    hit = {eval(x)[0] for x in test_decontaminate.plain(rows, [(1, ITEM)])}
    rows = [r for r in rows if r[0] not in hit or r[0] is None]
    out = []
    for r in rows:
        text = re.sub(r"\S+@\S+", "<EMAIL>", r[1] or "")
        out.append((r[0], re.sub(r"10\.1\.2\.3", "<IP>", text)))
    want = sorted(str((k, len(test_tokens.plain(t)) + 1)) for k, t in out)
    got = P.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert sorted({str((r["doc_id"], r["doc_tokens"])) for r in got.collect()}) == sorted(set(want))
    assert "501" in str(want) and "'502'" not in str(want) and 500 not in [r[0] for r in rows]
    for name, stage in P.STAGES[:-1]:
        docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name


def test_registered():
    import __spark_entry__

    assert "pipeline" in __spark_entry__.queries() and len([k for k in __spark_entry__.queries() if re.match(r"op\d+_", k)]) == 13
    assert [f.__name__ for _, f in P.STAGES] == ["good", "distinct", "unseen", "sanitised", "packed"] and P.ORACLE_SQL is None
    assert NEAR and all((jaccard, pack, privacy, quality))
