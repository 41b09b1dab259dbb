from __future__ import annotations

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from devfold.llm import privacy

from .conftest import messy_rows, table

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    odd = [int(d) for d in digits[::-1]]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(odd)) % 10 == 0


def plain(text):
    text = text or ""
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab1290.@-+ ()%é\n")), max_size=60))
def test_patterns(text):
    assert privacy.entities(text) == plain(text)


def test_long_runs_are_quick():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "+1" * 100_000, "@a" * 100_000, "a@" * 100_000):
        privacy.entities(text)


def test_counts_and_digest(messy):
    got = {str((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"])) for r in privacy.find_personal(messy).collect()}
    want = set()
    for key, text, *_ in messy_rows():
        spans = plain(text)
        number = [sum(k == i for _, k, _ in spans) for i in range(4)]
        digest = hashlib.sha256(",".join(f"{privacy.KINDS[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()
        want.add(str((key, *number, digest)))
    assert got == want and privacy.find_personal(messy).count() == len(messy_rows())


def corpus(spark):
    """One address with a word that only stands beside it, in differing contexts, among common words."""
    filler = [f"common{i % 50} words{i % 40} here{i % 30}" for i in range(3000)]
    rows = [(i, " ".join(filler[i * 10 : i * 10 + 10]), "en", "s", 1) for i in range(200)]
    rows += [(1000 + i, f"note{i} from the Zorblat office common{i} mail ann@example.com today words{i}", "en", "s", 1) for i in range(6)]
    rows += [(2000 + i, "copied Unique context bob@example.com of one text", "en", "s", 1) for i in range(30)]
    rows += [(3000, "Zorblat alone", "en", "s", 1)]
    return rows


def test_revealing_terms(spark):
    docs = table(spark, corpus(spark))
    rows = {r["doc_id"]: r for r in privacy.find_personal(docs).collect()}
    for i in range(6):
        text = f"note{i} from the Zorblat office common{i} mail ann@example.com today words{i}"
        at = text.index("Zorblat")
        assert f"term:{at}:{at + 7}" in rows[1000 + i]["spans"].split(",")
        assert not any(x.startswith("term") and text[int(x.split(":")[1]) :].startswith("common") for x in rows[1000 + i]["spans"].split(","))
    # copies of one text are one context, and a term is judged beside its entity only
    assert all("term" not in rows[2000 + i]["spans"] for i in range(30)) and rows[3000]["spans"] == ""


def test_sanitised_text(spark):
    rows = corpus(spark)
    docs = table(spark, rows)
    out = {r["doc_id"]: r for r in privacy.sanitised(docs).collect()}
    assert privacy.sanitised(docs).columns == docs.columns and len(out) == len(rows)
    assert out[2000]["text"] == "copied Unique context <EMAIL> of one text" and out[2000]["n_chars"] == len(out[2000]["text"])
    assert "Zorblat" not in out[1000]["text"] and "ann@" not in out[1000]["text"]
    assert out[0]["text"] == rows[0][1]


def test_messy_and_empty(messy, empty):
    assert privacy.sanitised(messy).count() == len(messy_rows())
    assert sum(r["text"] is None for r in privacy.sanitised(messy).collect()) == 2
    assert privacy.find_personal(empty).collect() == [] and privacy.sanitised(empty).collect() == []


def test_replaced():
    assert privacy.replaced("abcdefgh", "ip:0:4,card:3:6,term:7:8", {7: (0.9, "<WORD>")}, 0.95) == "<IP>g<WORD>"
    assert privacy.replaced("abcdefgh", "term:7:8", {7: (0.99, "<WORD>")}, 0.95) == "abcdefg"


def test_terms_are_marked_everywhere(spark):
    far = " ".join(f"far{i}" for i in range(20))
    rows = corpus(spark)
    rows += [(5000 + i, f"memo{i} from the Zorblat office common{i} mail ann@example.com today words{i}", "en", "s", 1) for i in range(90)]
    rows += [(4000, f"é 漢 ann@example.com {far} ZORBLAT zorblat@example.org x", "en", "s", 1), (None, "see Zorblat\nZorblat", "en", "s", 1), (None, "see Zorblat\nZorblat", "en", "s", 1)]
    docs = table(spark, rows)
    got = {}
    for r in privacy.find_personal(docs, everywhere=True).collect():
        got.setdefault(r["doc_id"], []).append(r["spans"])
    text = rows[-3][1]
    at = text.index("ZORBLAT")
    assert got[3000] == ["term:0:7"] and got[None] == ["term:4:11,term:12:19"] * 2
    assert [x for x in got[4000][0].split(",") if x.startswith("term")] == [f"term:{at}:{at + 7}"]
    out = [r["text"] for r in privacy.sanitised(docs).collect()]
    assert len(out) == len(rows) and not any("zorblat" in (t or "").lower() for t in out)
    assert sum("<EMAIL> x" in t for t in out) == 1


def test_registered_query_marks_everywhere(spark, tmp_path):
    from devfold.llm.queries import op7_disclosure

    table(spark, corpus(spark), extra=False).write.parquet(str(tmp_path / "documents.parquet"))
    assert {r["doc_id"]: r["spans"] for r in op7_disclosure(spark, str(tmp_path)).collect()}[3000] == "term:0:7"


def test_evidence_is_pooled(spark):
    rows = corpus(spark)
    rows += [(6000 + i, f"word{i} Quuxcorp staff{i} p{i}@quux.example.net line{i}", "en", "s", 1) for i in range(4)]
    rows += [(6100 + i, f"pay{i} Cardnum {number} line{i}", "en", "s", 1) for i, number in enumerate(("4111 1111 1111 1111", "5500-0000-0000-0004", "340000000000009"))]
    rows += [(6200 + i, f"pay{i} Spelled {number} end{i}", "en", "s", 1) for i, number in enumerate(("+1 555 010 9999", "+1 (555) 010-9999", "+15550109999"))]
    rows += [(6300 + i, f"copied Onetext {i // 20} beside r@quux.example.net", "en", "s", 1) for i in range(40)]
    rows += [(6400, "Quuxcorp Cardnum Spelled Onetext", "en", "s", 1)]
    got = {r["doc_id"]: r["spans"] for r in privacy.find_personal(table(spark, rows)).collect()}
    for key, term in [(6000, "Quuxcorp"), (6100, "Cardnum"), (6200, "Spelled")]:
        text = next(r[1] for r in rows if r[0] == key)
        assert f"term:{text.index(term)}:{text.index(term) + len(term)}" in got[key].split(",")
    assert all("term:7:14" not in got[6300 + i] for i in range(40))


def test_a_word_between_two_entities_counts_once():
    text = "a@x.example between b@x.example"
    near = privacy.nearby(text, privacy.entities(text), 5)
    assert [w[5] for w in near if w[1] == "between"] == [0b111, 0b001]
    assert privacy.pools(3, "+1 (555) 010-9999") == privacy.pools(3, "+15550109999") and privacy.pools(1, "10.0.0.01")[0] == privacy.pools(1, "10.0.0.1")[0]


def test_sanitised_with_clashing_names_and_rows(spark):
    text = "write to me.x@ex-a.example.com now"
    rows = [(1, text, "a", "b", 7), (None, text, "a", "b", 7), (None, None, "a", "b", 7), (2, "", "a", "b", 7), (1, text, "c", "b", 7), (1, "clean", "a", "b", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _spans string, row_key string, _id int")
    got = privacy.sanitised(docs)
    assert got.columns == docs.columns
    new = "write to <EMAIL> now"
    wanted = [(i, new if t == text else t, *rest) for i, t, *rest in rows]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, wanted))
    assert privacy.sanitised(docs.limit(0)).count() == 0
