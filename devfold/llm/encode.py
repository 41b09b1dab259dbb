"""Token ids of whole texts, through a table of words already seen.

The public word tokenizer cuts at white space before anything else, lower-cases,
and its normaliser never joins characters across a space. A text's ids are
therefore its words' ids in order; a mark that ends a word is a piece of its own.
Most words of a corpus repeat, so each distinct one goes through the library once
per worker. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import functools
import os
import re
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa

from devfold.llm import words as W

#: Words kept in one worker's table; beyond that it starts again. Bounds memory only.
KEPT_WORDS = 2_000_000
#: Words seen last are found at once by this many bits of their hash.
NEAR_BITS = 19
#: Text encoded at once.
RUN_BYTES = 4 << 20
_MARKS = np.zeros(256, bool)
_MARKS[list(b".,;:!?")] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
#: One piece for the tokenizer, and unchanged by its normaliser.
_PLAIN = re.compile("[a-zß-öø-ÿ]+").fullmatch
_TOKEN_ID = attrgetter("id")
#: The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on.
_ITSELF = {*range(33, 127), *range(161, 173), *range(174, 256)}
_ALPHABET = {b: b if b in _ITSELF else 256 + i for i, b in [*enumerate(sorted(set(range(256)) - _ITSELF))] + [(0, b) for b in _ITSELF]}


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Where a public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts under one tokenizer file."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.model._resize_cache(0)  # words are kept here instead
        self.forget()
        self.marks = {c: np.array(self._ids([chr(c)])[0], np.uint32) for c in np.flatnonzero(_MARKS).tolist()}

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.row = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.bounds = np.zeros(1, np.int64)
        # a slot that holds no word holds a hash that belongs to another slot
        self.near, self.near_row = np.zeros(1 << NEAR_BITS, np.uint64), np.zeros(1 << NEAR_BITS, np.int32)
        self.near[0] = 2**64 - 1

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _stems(self, texts: list[str]) -> list[list[int]]:
        """Ids of single words; plain ones go straight to the library's merge model, which is quicker."""
        merge = self.tokenizer.model.tokenize
        out: list[list[int]] = []
        rest = []
        for text in texts:
            if not _PLAIN(text):
                rest.append(len(out))
                out.append([])
            else:
                out.append(list(map(_TOKEN_ID, merge(text if text.isascii() else text.encode().decode("latin-1").translate(_ALPHABET)))))
        for i, ids in zip(rest, self._ids([texts[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        """Put words into the table; their hashes ascend and are not in it."""
        found = self._stems(texts)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        rows = len(self.bounds) - 1 + np.arange(len(found))
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, flat])
        at = np.searchsorted(self.known, hashes)
        self.known, self.row = np.insert(self.known, at, hashes), np.insert(self.row, at, rows)

    def _rows(self, hashes: np.ndarray, data: np.ndarray, words: W.Words) -> np.ndarray:
        """The table's row of each word; words not seen before are learnt."""
        if len(self.known) > KEPT_WORDS:
            self.forget()
        slot = hashes >> np.uint64(64 - NEAR_BITS)
        row = self.near_row[slot].astype(np.int64)
        far = np.flatnonzero(self.near[slot] != hashes)
        distinct, at, which = np.unique(hashes[far], return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != distinct[inside]
        if new.any():
            raw, first = data.tobytes(), far[at[new]]
            self._learn(distinct[new], [raw[s:e].decode() for s, e in zip(words.start[first].tolist(), words.end[first].tolist(), strict=True)])
            place = np.searchsorted(self.known, distinct)
        found = self.row[place]
        row[far] = found[which]
        slot, last = np.unique(distinct >> np.uint64(64 - NEAR_BITS), return_index=True)
        self.near[slot], self.near_row[slot] = distinct[last], found[last]
        return row

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin and end. Null counts as empty.

        Runs of texts of about ``RUN_BYTES`` are encoded together, which bounds the working memory.
        """
        _, offsets = W.buffers(texts)
        cuts = np.unique(np.searchsorted(offsets, np.arange(0, int(offsets[-1]) + RUN_BYTES, RUN_BYTES)))
        cuts = np.unique(np.clip(np.concatenate([[0], cuts, [len(texts)]]), 0, len(texts)))
        ids, bounds = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            own, ends = self._run(texts.slice(a, b - a))
            ids.append(own)
            bounds.append(ends[1:] + bounds[-1][-1])
        return np.concatenate(ids), np.concatenate(bounds)

    def _run(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = W.split(texts)
        if _has_special(words.data):
            return self._whole(texts)
        words.data = W.LOWER[words.data]
        data, end = words.data, words.end
        solo = end - words.start < 2
        last, prior = data[end - 1], data[np.maximum(end - 2, 0)]
        lead = data[np.maximum(end - 3, 0)]
        letter = _ALNUM[prior] | (lead == 0xC3) & (prior >= 0x80) & (prior < 0xC0) & (prior != 0x97) & (prior != 0xB7)
        tailed = _MARKS[last] & letter & ~solo
        words.end = end - tailed
        row = self._rows(W.word_hashes(words), data, words)
        begin, size = self.bounds[row], self.bounds[row + 1] - self.bounds[row]
        total = size + tailed
        ends = np.concatenate([[0], np.cumsum(total)])
        # the place after a word's ids is its mark's, if it has one, and read from the next word until then
        out = np.append(self.ids, np.uint32(0))[W.runs(begin, total)]
        marks = np.zeros(256, np.uint32)
        for c, ids in self.marks.items():
            marks[c] = ids[0]
        out[ends[1:][tailed] - 1] = marks[last[tailed]]
        return out, ends[words.first]

    def _whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Batches that hold the text of a special token go through the library as they are."""
        found = self._ids([t or "" for t in texts.to_pylist()])
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for x in found for i in x), np.uint32, int(sizes.sum())), np.concatenate([[0], np.cumsum(sizes)])


def _has_special(data: np.ndarray) -> bool:
    return bool(((data[:-1] == ord("<")) & (data[1:] == ord("|"))).any())


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's ids followed by the end id."""
    sizes = np.diff(bounds)
    ends = bounds + np.arange(len(bounds))
    out = np.full(int(ends[-1]), end_id, np.uint32)
    out[W.runs(ends[:-1], sizes)] = ids
    return out, ends


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(path)
