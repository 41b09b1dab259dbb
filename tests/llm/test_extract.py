from __future__ import annotations

import html
import re

import numpy as np
import pytest

from devfold.llm import extract as X

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labeller(spark):
    return X.train(spark.read.parquet(f"{FOLDER}/pages.parquet"), 120)


def plain(page):
    """Text of the article element, block by block."""
    body = page[page.index("<article>") + 9 :].split("</article>")[0]
    body = re.sub(r"<[^>]*>", " ", re.sub(r"</?(?:p|h1)[^>]*>", "\x00", body))
    lines = (re.sub(r"\s+", " ", html.unescape(x)).strip() for x in body.split("\x00"))
    return "\n".join(x for x in lines if x)


def test_every_page(spark, labeller):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    got = {r["page_id"]: r for r in X.extract(pages, labeller).collect()}
    wrong = [r["page_id"] for r in pages.collect() if got[r["page_id"]]["text"] != plain(r["html"])]
    assert len(wrong) <= 0.01 * len(got) and all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_held_out_blocks_without_telling_tags(spark, labeller):
    rows = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").where("page_id % 7 = 3").collect()
    blocks = [X.parse(r["html"]) for r in rows]
    labels = labeller.label([X.features(X.renamed(b)) for b in blocks])
    right = np.concatenate([x == X.taught(b) for x, b in zip(labels, blocks)])
    assert right.mean() > 0.98


def test_gradients():
    rng = np.random.default_rng(1)
    model = X.Labeller()
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    pages = [(rng.normal(size=(n, X.INPUTS)), (rng.random(n) > 0.5).astype(float)) for n in (3, 5)]
    x, mask, y = X.padded(pages)
    x = x.astype(np.float64)

    def loss():
        z = model.logits(x, mask)
        return float((np.where(mask, np.logaddexp(0, z) - y * z, 0)).sum() / mask.sum())

    grads = model.gradients(x, mask, y)
    for key, value in model.weights.items():
        for place in [tuple(rng.integers(0, s) for s in value.shape) for _ in range(4)]:
            old = value[place]
            value[place] = old + 1e-4
            up = loss()
            value[place] = old - 1e-4
            down = loss()
            value[place] = old
            assert abs((up - down) / 2e-4 - grads[key][place]) < 1e-3


def test_order_does_not_change_labels(labeller):
    page = "<nav><a href=x>One</a></nav><article><p>Some text here.</p><p>More text there.</p></article><footer>Foot</footer>"
    own = X.features(X.parse(page))
    long = np.concatenate([own] * 9)
    alone, together = labeller.label([own])[0], labeller.label([long, own, long[:0]])
    assert (alone == together[1]).all() and len(together[2]) == 0


def test_parser():
    page = """<html><head><title>T</title><style>p{}</style></head><body><!-- c <p>x</p> --><script>var a="<p>no</p>";</script>
    <div class="main Text">A &amp;amp; B&nbsp;<b>bo<i>ld</i></b> c<br>d<p>one<p>two <a href='>'>link</a> end<ul><li>i1<li>i2</ul><form><input value=v>f<select><option>o</select></form>tail</div>"""
    assert [(b.text, b.path[-1]) for b in X.parse(page)] == [("A &amp; B bold c d", "div main text"), ("one", "p"), ("two link end", "p"), ("i1", "li"), ("i2", "li"), ("f", "form"), ("tail", "div main text")]
    assert X.parse("") == [] and [b.text for b in X.parse("a < b <")] == ["a < b <"]


def test_title_in_the_header_of_an_article(labeller):
    page = "<body><header><p>Site name</p></header><nav><a href=x>One</a> <a href=y>Two</a></nav><article><header><h1>Flood in town</h1></header><p>Some words on the flood and on what it did to the town.</p><p>More words on the flood, the town and the river that runs there.</p></article><footer><p>Imprint</p></footer></body>"
    blocks = X.parse(page)
    assert [b.text for b, y in zip(blocks, X.taught(blocks)) if y][0] == "Flood in town"
    kept = [b.text for b, y in zip(blocks, X.checked(blocks, labeller.label([X.features(blocks)])[0])) if y]
    assert kept[0] == "Flood in town" and len(kept) == 3


def test_formulas_stay_in_their_paragraph():
    (block,) = X.parse("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p>")
    assert block.text == "so x=1 holds"


def test_every_word_of_a_block_counts():
    path = ("div", "p")
    one, two = (X.features([X.Block(path, "same " * 60 + tail, 0)]) for tail in ("ends here", "goes there"))
    assert (one != two).any()
    cells = X.features([X.Block(path, "same " * 60, 0)])[0, X.PATH_CELLS : X.PATH_CELLS + X.WORD_CELLS]
    assert cells.max() == 1


def test_sample_of_whole_pages(spark, monkeypatch):
    """Equal rows are drawn once, and pages beyond the characters are passed over, not cut."""
    shown = []
    monkeypatch.setattr(X, "parse", lambda page: shown.append(page) or [])
    rows = [(1, "u", "a" * 50)] * 30 + [(2, "v", "b" * 500), (3, "w", "c" * 40), (None, None, "d" * 30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    X.train(pages, 240, 200)
    assert sorted(shown) == ["a" * 50, "c" * 40, "d" * 30]
    shown.clear()
    X.train(pages, 2, 10**6)
    assert len(shown) == 2


def test_messy(spark, labeller):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "   "), (4, "u", "plain text"), (4, "u", "plain text"), (None, "u", "<p>" * 5000 + "deep"), (6, "u", "<article>" + "<p>word word word.</p>" * 5000 + "</article>"), (7, "u", "<<<>>><a<b>&#x110000;&bogus;")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = X.extract(pages, labeller).collect()
    assert len(got) == len(rows) and all(r["text"] is not None and r["n_chars"] == len(r["text"]) for r in got)
    assert {r["page_id"]: r["text"] for r in got}[6].count("word word word.") == 5000
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert X.extract(none).collect() == []
