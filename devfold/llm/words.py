"""Words of a batch of texts as numpy arrays, and rolling hashes over them.

A word is a run of bytes other than space and ``\\x09``-``\\x0D``. Working on the UTF-8
bytes is safe: no byte of a longer character falls into that range.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

U64 = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240611))
BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
#: Odd bases: powers of an odd number can be undone modulo 2**64.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
_SEGMENT = 1 << 20
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for ``i`` below ``size``."""
    known = _powers.get(base)
    if known is None or len(known[0]) < size:
        size = max(size, 1 << 16)
        tables = []
        for step in (base, pow(base, -1, 2**64)):
            table = np.full(size, step, U64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        known = _powers[base] = (tables[0], tables[1])
    return known


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@dataclass
class Words:
    """``data[start[i]:end[i]]`` is word ``i``; text ``d`` has words ``first[d]:first[d + 1]``."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(texts: pa.Array | pa.ChunkedArray, lower: bool = False) -> Words:
    """Words of every text; ``lower`` changes A-Z to a-z."""
    data, offsets = buffers(texts)
    if lower:
        data = LOWER[data]
    solid = ~SPACE[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = solid[:-1], solid[1:]
    held = offsets[:-1] < offsets[1:]
    before[offsets[:-1][held]] = False
    after[offsets[1:][held] - 1] = False
    start, end = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def word_hashes(words: Words, table: np.ndarray = BYTE, base: int = BYTE_BASE) -> np.ndarray:
    """A 64-bit hash of each word, from prefix sums taken a segment at a time."""
    out = np.empty(len(words.start), U64)
    at = 0
    while at < len(out):
        origin = words.start[at]
        until = max(at + 1, int(np.searchsorted(words.end, origin + _SEGMENT, "right")))
        stop = words.end[until - 1]
        up, down = powers(base, int(stop - origin) + 1)
        sums = np.zeros(stop - origin + 1, U64)
        np.cumsum(table[words.data[origin:stop]] * up[: stop - origin], out=sums[1:])
        s, e = words.start[at:until] - origin, words.end[at:until] - origin
        out[at:until] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U64) * U64(0xA24BAED4963EE407))
        at = until
    return out


def windows(hashes: np.ndarray, first: np.ndarray, width: int, base: int = WORD_BASE) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hash of every run of ``width`` words within one text, and the word it starts at."""
    counts = np.diff(first)
    fits = np.maximum(counts - width + 1, 0)
    if not fits.sum():
        return np.zeros(0, U64), np.zeros(0, np.int64)
    up, down = powers(base, len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, U64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    start = runs(first[:-1], fits)
    return mix((sums[start + width] - sums[start]) * down[start]), start


def runs(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``start[i], start[i] + 1, ...`` for ``length[i]`` steps, one run after another."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(length)
    return np.arange(total) + np.repeat(start - (ends - length), length)


def ragged(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """One binary cell for each ``values[bounds[i]:bounds[i + 1]]``."""
    raw = np.ascontiguousarray(values)
    places = (bounds * raw.itemsize).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(places), pa.py_buffer(raw)]).cast(kind or pa.binary())
