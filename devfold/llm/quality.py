"""Quality rules from tokeniser fertility, beside counted base rules.

Two public vocabularies read every text: characters per token and the entropy of the
token distribution come from the word vocabulary, the share of byte-fallback tokens from
the piece vocabulary. Each language has a band for each measure; a text outside any band
is rejected. Distinct words are encoded once per worker. Map-only: no shuffle.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devfold.llm import encode
from devfold.llm import words as W
from devfold.llm.common import STAGE_BATCH_BYTES, release, small_batches

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
#: First bytes of letters: Latin ones (1, up to U+027F), and of other scripts (-1); punctuation and symbols from U+2000 on count for none.
SCRIPT = np.zeros(256, np.int8)
SCRIPT[[*range(65, 91), *range(97, 123), *range(0xC3, 0xCA)]] = 1
SCRIPT[[*range(0xCA, 0xE2), *range(0xE3, 0xF0)]] = -1
LEAST_WORDS, MOST_REPEATED = 50, 50


@dataclass(frozen=True)
class Band:
    """Bounds (both allowed) of what a text of one language may measure."""

    chars_per_token: tuple[float, float]
    most_fallback: float
    #: Least entropy in bits by the logarithm (base 2) of the number of tokens, linear in between.
    least_entropy: tuple[tuple[float, float], ...]

    def floor(self, tokens: float) -> float:
        return float(np.interp(np.log2(max(tokens, 1)), *zip(*self.least_entropy, strict=True)))


class PieceCounts:
    """Tokens and byte-fallback tokens of single words under a sentencepiece model."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        self.forget()

    def forget(self) -> None:
        self.known, self.tokens, self.bytes = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def count(self, words: W.Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        distinct, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > encode.KEPT_WORDS:
            self.forget()
        place = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != distinct[inside]
        if new.any():
            raw, first = words.data.tobytes(), at[new]
            found = self.model.encode([raw[s:e].decode() for s, e in zip(words.start[first].tolist(), words.end[first].tolist(), strict=True)], num_threads=1)
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = self.is_byte[np.fromiter((i for x in found for i in x), np.int64, int(sizes.sum()))]
            ends = np.cumsum(sizes)
            sums = np.concatenate([[0], np.cumsum(flat)])
            known = np.concatenate([self.known, distinct[new]])
            order = np.argsort(known, kind="stable")
            self.known = known[order]
            self.tokens = np.concatenate([self.tokens, sizes.astype(np.int32)])[order]
            self.bytes = np.concatenate([self.bytes, (sums[ends] - sums[ends - sizes]).astype(np.int32)])[order]
            place = np.searchsorted(self.known, distinct)
        row = place[which]
        return self.tokens[row], self.bytes[row]


@functools.lru_cache(maxsize=2)
def piece_counts(path: str) -> PieceCounts:
    return PieceCounts(path)


def sums_by(bounds: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of ``values[bounds[i]:bounds[i + 1]]``."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def repeated_words(hashes: np.ndarray, first: np.ndarray, width: int = 3) -> np.ndarray:
    """For each text, the words covered by a window of ``width`` words that occurs twice or more in it."""
    keys, start = W.windows(hashes, first, width)
    if not len(keys):
        return np.zeros(len(first) - 1, np.int64)
    text = np.searchsorted(first, start, "right") - 1
    _, which, counts = np.unique(W.mix(keys + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
    start = start[counts[which] > 1]
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + width, -1)
    return sums_by(first, np.cumsum(edge[:-1]) > 0)


def repeated_lines(words: W.Words) -> np.ndarray:
    """For each text, the lines with a word that equal an earlier line."""
    breaks = np.flatnonzero(words.data == 10)
    cuts = np.unique(np.concatenate([breaks + 1, words.offsets]))
    start, end = cuts[:-1], cuts[1:].copy()
    end -= np.isin(end, breaks + 1) & (words.data[np.maximum(end - 1, 0)] == 10)
    filled = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    start, end = start[filled], end[filled]
    text = np.searchsorted(words.offsets, start, "right") - 1
    lines = W.Words(words.data, words.offsets, start, end, words.first)
    keys = W.mix(W.word_hashes(lines) + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(keys, return_index=True)
    again = np.ones(len(keys), np.int64)
    again[first] = 0
    return np.bincount(text, again, len(words.offsets) - 1).astype(np.int64)


def entropy(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Entropy in bits of each text's token distribution; 0 for a text without tokens."""
    size = np.diff(bounds)
    text = np.repeat(np.arange(len(size), dtype=np.int64), size)
    keys, counts = np.unique(text << 32 | ids.astype(np.int64), return_counts=True)
    owner = keys >> 32
    share = counts / size[owner]
    return np.abs(np.bincount(owner, -share * np.log2(share), len(size)))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "chars_per_token", "fallback_share", "token_entropy", "n_ids")


def measures(texts: pa.Array, word_vocabulary: str, piece_vocabulary: str) -> dict[str, np.ndarray]:
    """Base counts and fertility measures of each text; a text without words measures 0 throughout."""
    words = W.split(texts)
    hashes = W.word_hashes(words)
    wide = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    chars = sums_by(words.first, wide[words.end] - wide[words.start])
    pieces, fallback = piece_counts(piece_vocabulary).count(words, hashes)
    ids, bounds = encode.encoder(word_vocabulary).encode(texts)
    values = (
        sums_by(words.offsets, SCRIPT[words.data]),
        words.counts,
        chars,
        sums_by(words.offsets, SYMBOLS[words.data]),
        repeated_lines(words),
        repeated_words(hashes, words.first),
        chars / np.maximum(np.diff(bounds), 1),
        sums_by(words.first, fallback) / np.maximum(sums_by(words.first, pieces), 1),
        entropy(ids, bounds),
        np.diff(bounds),
    )
    return dict(zip(("script", *MEASURES), values, strict=True))


#: Bands by language, set between the good and bad labelled documents of the sf0.1 tables
#: (3,980 labels); entropy of a token sample grows with its length, so its floor does too.
_LENGTHS = (6.5, 7.5, 8.5, 9.5, 10.5, 11.5, 12.5)
BANDS = {
    "en": Band((1.9, 3.0), 0.05, tuple(zip(_LENGTHS, (5.30, 5.75, 6.10, 6.38, 6.55, 6.66, 6.70), strict=True))),
    "de": Band((1.9, 2.8), 0.05, tuple(zip(_LENGTHS, (5.30, 5.62, 5.92, 6.15, 6.27, 6.35, 6.40), strict=True))),
    "es": Band((1.65, 2.6), 0.05, tuple(zip(_LENGTHS, (5.20, 5.40, 5.80, 6.07, 6.27, 6.35, 6.45), strict=True))),
    "fr": Band((1.5, 2.7), 0.05, tuple(zip(_LENGTHS, (5.25, 5.50, 5.72, 5.90, 6.02, 6.07, 6.10), strict=True))),
}
#: For other languages and null, by the script most letters of the text have: Latin letters get the widest limits of
#: the four languages; of other scripts only gross failures are known.
LATIN = Band(
    (min(b.chars_per_token[0] for b in BANDS.values()), max(b.chars_per_token[1] for b in BANDS.values())),
    max(b.most_fallback for b in BANDS.values()),
    tuple((size, min(dict(b.least_entropy)[size] for b in BANDS.values())) for size in _LENGTHS),
)
WIDEST = Band((0.5, 12.0), 0.50, tuple(zip(_LENGTHS, (3.0, 3.25, 3.5, 3.75, 4.0, 4.25, 4.5), strict=True)))


def band_of(lang: str | None, script: int, bands: dict[str, Band], widest: Band) -> Band:
    """The band of a language, by the first part of its tag, or else that of the script most letters of the text have."""
    known = bands.get(re.split("[-_]", lang.strip().lower())[0]) if lang else None
    return known or (LATIN if script >= 0 else widest)


def verdicts(values: dict[str, np.ndarray], langs: list[str | None], bands: dict[str, Band], widest: Band) -> tuple[np.ndarray, np.ndarray]:
    """Base failures, and which texts are kept."""
    words = values["n_words"]
    failed = (words < LEAST_WORDS) | (100 * values["n_repeat_words"] > MOST_REPEATED * words)
    own = [band_of(x, s, bands, widest) for x, s in zip(langs, values["script"].tolist(), strict=True)]
    low, high = np.array([b.chars_per_token for b in own], float).reshape(-1, 2).T
    inside = (values["chars_per_token"] >= low) & (values["chars_per_token"] <= high)
    inside &= values["fallback_share"] <= np.array([b.most_fallback for b in own], float)
    inside &= values["token_entropy"] >= np.array([b.floor(n) for b, n in zip(own, values["n_ids"], strict=True)], float)
    return failed, inside & ~failed


OUT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
    "chars_per_token double, fallback_share double, token_entropy double"
)


def _judge(batch: pa.RecordBatch, files: tuple[str, str], bands: dict[str, Band], widest: Band) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    names = batch.schema.names
    values = measures(batch.column(names.index("text")), *files)
    langs = batch.column(names.index("lang")).to_pylist() if "lang" in names else [None] * batch.num_rows
    return values, *verdicts(values, langs, bands, widest)


def _files(word_vocabulary: str | None, piece_vocabulary: str | None) -> tuple[str, str]:
    return word_vocabulary or encode.vocabulary(), piece_vocabulary or encode.vocabulary("piece_bpe_32k.model")


def judged(docs: DataFrame, bands: dict[str, Band] | None = None, widest: Band = WIDEST, word_vocabulary: str | None = None, piece_vocabulary: str | None = None) -> DataFrame:
    """Counts, measures and verdict of every row.

    ``bands`` are by language, the first part of a tag such as ``en-GB``; texts of other languages are held to the widest
    limits of the known ones where most of their letters are Latin, else to ``widest``. To set bands for a language, take the
    measures of texts known to be good. A null or empty text has no words and fails the base rules. Rows are judged one by one;
    null ids and languages are allowed, as is a table without ``lang``. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    files, own = _files(word_vocabulary, piece_vocabulary), BANDS if bands is None else bands
    lang = [F.col("lang").cast("string").alias("lang")] if "lang" in docs.columns else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *lang)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, failed, kept = _judge(batch, files, own, widest)
            columns = {"doc_id": batch.column(0)} | {k: pa.array(values[k]) for k in MEASURES} | {"base_failed": pa.array(failed), "kept": pa.array(kept)}
            names = [x.split()[0] for x in OUT.split(", ")]
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)
            release()

    return rows.mapInArrow(judge, OUT)


def kept(docs: DataFrame, bands: dict[str, Band] | None = None, widest: Band = WIDEST, word_vocabulary: str | None = None, piece_vocabulary: str | None = None) -> DataFrame:
    """The rows that :func:`judged` keeps, with all their columns."""
    small_batches(docs.sparkSession, STAGE_BATCH_BYTES)
    files, own = _files(word_vocabulary, piece_vocabulary), BANDS if bands is None else bands

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_judge(batch, files, own, widest)[2]))
            release()
        # the worker goes on to other stages and must not take the word tables along
        encode.encoder(files[0]).forget()
        piece_counts(files[1]).forget()
        release()

    return docs.mapInArrow(keep, docs.schema)
