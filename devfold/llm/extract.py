"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks: the text between block-level tags, with
the path of open tags. A bidirectional LSTM in numpy reads hashed tag paths and hashed words
of all blocks of a page and labels each one as main text or not, so a block is judged by what
stands before and after it. It is trained here, on a bounded sample of pages, against labels
that follow from the meaning of HTML's own elements and of usual class names; training
pages are also shown with their telling tags renamed, so that the surroundings have to
speak. Elements that never hold text (scripts, styles, forms, ...) do not become blocks.
"""

from __future__ import annotations

import functools
import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devfold.llm.common import small_batches

#: Training sample: pages and characters at most, always of whole pages. Passes, and pages in a step.
SAMPLE_PAGES, SAMPLE_CHARS, PASSES, STEP_PAGES = 240, 16_000_000, 4, 16
HIDDEN, PATH_CELLS, WORD_CELLS, NUMBERS = 16, 128, 64, 4
INPUTS = PATH_CELLS + WORD_CELLS + NUMBERS

# Element names of HTML.
SILENT = frozenset("script style noscript template head title svg iframe object canvas audio video select textarea button option datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo cite code data dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var del big math mi mn mo mrow mtext msup msub mfrac msqrt semantics".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
ITEMS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
MAIN = frozenset(("article", "main"))
AROUND = frozenset("nav header footer aside form menu dialog".split())
#: Class or id words of surroundings.
AROUND_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer footer gdpr header login masthead menu modal nav "
    "navbar navigation newsletter notice pager pagination popup promo promoted related reply replies respond sharing share sidebar signup social sponsor sponsored "
    "subscribe toolbar widget".split()
)

_TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|</?[a-zA-Z][^\s/>]*(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:>|$)|</?[a-zA-Z][^>]*(?:>|$)", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_MARKS = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int


def parse(page: str) -> list[Block]:
    """Leaf blocks of a page in order; markup that is not closed ends with its parent."""
    blocks: list[Block] = []
    stack: list[str] = []
    parts: list[str] = []
    path: tuple[str, ...] = ()
    linked = anchors = 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                blocks.append(Block(path, text, linked))
        parts, linked = [], 0

    def names(entry: str) -> str:
        return entry.partition(" ")[0]

    def pop_to(at: int) -> None:
        nonlocal anchors
        anchors -= sum(names(s) == "a" for s in stack[at:])
        del stack[at:]

    def add(text: str) -> None:
        nonlocal path, linked
        if not parts:
            if not text.strip():
                return
            path = tuple(s for s in stack if names(s) not in INLINE)
        parts.append(text)
        if anchors:
            linked += len(text.strip())

    at = 0
    while at < len(page):
        found = _TAG.search(page, at)
        if not found:
            add(page[at:])
            break
        if found.start() > at:
            add(page[at : found.start()])
        tag, at = found[0], found.end()
        if tag.startswith("<![CDATA["):
            add(html.escape(tag[9:].removesuffix("]]>")))
            continue
        name = _NAME.match(tag)
        if not name:
            continue
        element = name[1].lower()
        if tag[1] == "/":
            if element not in INLINE:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if names(stack[i]) == element:
                    pop_to(i)
                    break
                if element in INLINE and names(stack[i]) not in INLINE:
                    break
            if element in VOID and element != "br":
                continue
            continue
        if element == "br":
            if parts:
                parts.append(" ")
            continue
        if element in VOID:
            if element == "hr":
                flush()
            continue
        if element in SILENT:
            if element not in ("button", "svg", "select", "textarea", "option"):
                flush()
            if not tag.endswith("/>") and element not in ("head", "option"):
                end = re.compile(rf"</{re.escape(element)}\s*>", re.I).search(page, at)
                if element in ("script", "style", "title", "textarea", "noscript", "template", "iframe") or end:
                    at = end.end() if end else len(page)
            continue
        if element not in INLINE:
            flush()
            if element in CLOSES_P:
                for i in range(len(stack) - 1, -1, -1):
                    if names(stack[i]) == "p":
                        pop_to(i)
                        break
                    if names(stack[i]) not in INLINE:
                        break
            elif element in ITEMS:
                for i in range(len(stack) - 1, -1, -1):
                    if names(stack[i]) in ITEMS[element]:
                        pop_to(i)
                        break
                    if names(stack[i]) in ("ul", "ol", "dl", "table", "menu"):
                        break
        if not tag.endswith("/>"):
            marks = " ".join(x for m in _MARKS.findall(tag) for x in _SPLIT.split("".join(m).lower()) if x)
            stack.append(f"{element} {marks}" if marks else element)
            anchors += element == "a"
    flush()
    return blocks


def outer(path: tuple[str, ...]) -> tuple[str, ...]:
    """The path without the headers of an article or main element: those hold its title, not that of the page."""
    first = next((i for i, s in enumerate(path) if s.partition(" ")[0] in MAIN), len(path))
    return tuple(s for i, s in enumerate(path) if i < first or s.partition(" ")[0] != "header")


def taught(blocks: list[Block]) -> np.ndarray:
    """Labels from the meaning of elements: inside an article or main element, and inside no surroundings.

    A page without such an element counts blocks outside surroundings that are mostly not links.
    """
    inside = [any(s.partition(" ")[0] in MAIN for s in b.path) for b in blocks]
    around = [any(s.partition(" ")[0] in AROUND or AROUND_WORDS.intersection(s.split(" ")[1:]) for s in outer(b.path)) for b in blocks]
    if any(inside):
        return np.array([i and not a for i, a in zip(inside, around, strict=True)])
    return np.array([not a and 2 * b.linked < len(b.text) for a, b in zip(around, blocks, strict=True)], bool)


@functools.lru_cache(maxsize=1 << 16)
def cell(text: str, cells: int) -> int:
    return zlib.crc32(text.encode()) % cells


def features(blocks: list[Block]) -> np.ndarray:
    """One row a block: hashed path entries, hashed words, and four numbers."""
    out = np.zeros((len(blocks), INPUTS), np.float32)
    seen: dict[tuple[str, ...], np.ndarray] = {}
    for row, block in zip(out, blocks, strict=True):
        known = seen.get(block.path)
        if known is None:
            known = seen[block.path] = np.zeros(PATH_CELLS, np.float32)
            path = outer(block.path)
            for entry in path:
                for word in entry.split(" "):
                    known[cell(word, PATH_CELLS)] = 1
            if path:
                known[cell("^" + path[-1].partition(" ")[0], PATH_CELLS)] = 1
        row[:PATH_CELLS] = known
        words = block.text.split()
        cells = np.fromiter((cell(word, WORD_CELLS) for word in block.text.lower().split()), np.int64)
        row[PATH_CELLS : PATH_CELLS + WORD_CELLS] = np.bincount(cells, minlength=WORD_CELLS) / max(1, len(words))
        size = len(block.text)
        row[-NUMBERS:] = (np.log1p(size) / 5, block.linked / size, np.log1p(len(words)) / 4, block.text[-1] in ".!?")
    return out


def renamed(blocks: list[Block]) -> list[Block]:
    """The same page with its telling elements as plain ones, to be judged by position and content."""
    swap = {e: "div" for e in MAIN | AROUND}
    return [Block(tuple(swap.get(s.partition(" ")[0], s.partition(" ")[0]) for s in b.path), b.text, b.linked) for b in blocks]


class Labeller:
    """Bidirectional LSTM over blocks, with one output a block."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        scale = 1 / np.sqrt(HIDDEN)
        self.weights = {}
        for side in "lr":
            self.weights[f"x{side}"] = rng.normal(0, 0.1, (INPUTS, 4 * HIDDEN)).astype(np.float32)
            self.weights[f"h{side}"] = rng.normal(0, scale, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            self.weights[f"b{side}"] = np.concatenate([np.ones(HIDDEN), np.zeros(3 * HIDDEN)]).astype(np.float32)
        self.weights["o"] = rng.normal(0, scale, 2 * HIDDEN).astype(np.float32)
        self.weights["c"] = np.zeros(1, np.float32)

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states of a padded batch (pages, blocks, inputs), in reading order of the side."""
        w, u, b = (self.weights[k + side] for k in "xhb")
        steps = range(x.shape[1]) if side == "l" else range(x.shape[1] - 1, -1, -1)
        projected = x @ w + b
        h = np.zeros((len(x), HIDDEN), np.float32)
        c = np.zeros_like(h)
        out = np.zeros((*x.shape[:2], HIDDEN), np.float32)
        kept = []
        for t in steps:
            z = projected[:, t] + h @ u
            f, i, o = (1 / (1 + np.exp(-np.clip(z[:, k * HIDDEN : (k + 1) * HIDDEN], -30, 30))) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            live = mask[:, t, None]
            new = f * c + i * g
            squashed = np.tanh(new)
            if keep:
                kept.append((t, h, c, f, i, o, g, squashed, live))
            c = np.where(live, new, c)
            h = np.where(live, o * squashed, h)
            out[:, t] = h
        return out, kept

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        states = np.concatenate([self._run(x, mask, s, False)[0] for s in "lr"], -1)
        return states @ self.weights["o"] + self.weights["c"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss, back through both directions."""
        runs = {s: self._run(x, mask, s, True) for s in "lr"}
        states = np.concatenate([runs["l"][0], runs["r"][0]], -1)
        p = 1 / (1 + np.exp(-np.clip(states @ self.weights["o"] + self.weights["c"], -30, 30)))
        d = np.where(mask, p - y, 0).astype(np.float32) / max(1, mask.sum())
        grads = {"o": np.einsum("pb,pbh->h", d, states), "c": np.array([d.sum()], np.float32)}
        for n, side in enumerate("lr"):
            u = self.weights["h" + side]
            top = d[..., None] * self.weights["o"][n * HIDDEN : (n + 1) * HIDDEN]
            dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            du = np.zeros_like(u)
            dh, dc = np.zeros((len(x), HIDDEN), np.float32), np.zeros((len(x), HIDDEN), np.float32)
            for t, h, c, f, i, o, g, squashed, live in reversed(runs[side][1]):
                dh = dh + top[:, t]
                inner = np.where(live, dh * o * (1 - squashed**2) + dc, 0)
                dz = np.concatenate([inner * c * f * (1 - f), inner * g * i * (1 - i), np.where(live, dh * squashed, 0) * o * (1 - o), inner * i * (1 - g**2)], 1)
                dz_all[:, t] = dz
                du += h.T @ dz
                dh = np.where(live, dz @ u.T, dh)
                dc = np.where(live, inner * f, dc)
            flat = dz_all.reshape(-1, 4 * HIDDEN)
            grads["x" + side], grads["h" + side], grads["b" + side] = x.reshape(-1, INPUTS).T @ flat, du, flat.sum(0)
        return grads

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], passes: int = PASSES, rate: float = 0.01, seed: int = 7) -> Labeller:
        """Adam over batches of pages of similar length."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        order = sorted(range(len(pages)), key=lambda i: len(pages[i][0]))
        batches = [order[i : i + STEP_PAGES] for i in range(0, len(order), STEP_PAGES)]
        for _ in range(passes):
            for at in rng.permutation(len(batches)):
                x, mask, y = padded([pages[i] for i in batches[at]])
                step += 1
                for k, g in self.gradients(x, mask, y).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.weights[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Main or not, for every block of every page; pages of similar length run together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        filled = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
        while filled:
            cells, group = 0, []
            while filled and (not group or (len(group) + 1) * len(pages[filled[0]]) <= 20_000):
                group.append(filled.pop(0))
            x, mask, _ = padded([(pages[i], np.zeros(len(pages[i]))) for i in group])
            for i, row in zip(group, self.logits(x, mask), strict=True):
                out[i] = row[: len(pages[i])] > 0
        return out


def padded(pages: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    longest = max(len(x) for x, _ in pages)
    x = np.zeros((len(pages), longest, INPUTS), np.float32)
    mask, y = np.zeros((len(pages), longest), bool), np.zeros((len(pages), longest), np.float32)
    for i, (own, labels) in enumerate(pages):
        x[i, : len(own)], mask[i, : len(own)], y[i, : len(own)] = own, True, labels
    return x, mask, y


def train(pages: DataFrame, sample: int = SAMPLE_PAGES, chars: int = SAMPLE_CHARS) -> Labeller:
    """A labeller fitted on at most ``sample`` whole pages of at most ``chars`` characters together.

    They are taken by ascending hash of the row, equal rows once; a page that goes beyond the characters is passed over.
    """
    hashed = pages.where("html IS NOT NULL").select("html", F.xxhash64("page_id", "url", "html").alias("_h"))
    known = hashed.select("_h", F.char_length("html").alias("_n")).distinct().orderBy("_h").limit(sample).collect()
    taken, left = [], chars
    for h, size in known:
        if size <= left:
            taken.append(h)
            left -= size
    rows = hashed.where(F.col("_h").isin(taken)).groupBy("_h").agg(F.first("html").alias("html")).orderBy("_h").select("html").collect()
    shown = []
    for (page,) in rows:
        blocks = parse(page)
        if blocks:
            labels = taught(blocks)
            shown += [(features(blocks), labels), (features(renamed(blocks)), labels)]
    return Labeller().fit(shown) if shown else Labeller()


def extract(pages: DataFrame, labeller: Labeller | None = None, sample: int = SAMPLE_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    Blocks labelled as main text, joined by a line feed, are the text; white space in a block
    is one space. A block inside an element that HTML reserves for surroundings is never main
    text, whatever its label; the header of an article or main element is judged like the rest of it. A null or empty page, or one without main
    text, gives an empty text. Pages are whole; rows with null or repeated ids stay rows.
    Only ``page_id``, ``url`` and ``html`` are read.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    model = labeller or train(rows, sample)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = [parse(x or "") for x in batch.column(2).to_pylist()]
            labels = model.label([features(b) for b in blocks])
            texts = ["\n".join(b.text for b, keep in zip(own, checked(own, main), strict=True) if keep) for own, main in zip(blocks, labels, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    return rows.mapInArrow(read, "page_id long, url string, text string, n_chars long")


def checked(blocks: list[Block], labels: np.ndarray) -> np.ndarray:
    """Labels without the blocks that stand in an element of the surroundings; the header of an article is none."""
    return labels & np.array([not any(s.partition(" ")[0] in AROUND for s in outer(b.path)) for b in blocks], bool)
