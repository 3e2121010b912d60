"""The same encoding as ``words_bpe``, over arrays of bytes instead of single words.

Texts of ASCII and Latin letters are split into words where the class of their bytes changes
(letter, digit, other, white space), which is the tokenizer's split rule for texts without
an apostrophe. Words are told apart by 64-bit hashes, each distinct one is looked up or
encoded once, and the ids are gathered for all places at once. Other texts, and those with
an apostrophe or the beginning of a special token, go to ``words_bpe`` one by one.

What is kept is bounded: ``KEEP`` words, their hashes sorted in one array; new words are
gathered apart and merged in by lots. When it is full, all are dropped and it fills anew.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa

from namewake.llm.common import U64, by_text, hash_words
from namewake.llm.words_bpe import WordEncoder, encoder

KEEP, MERGE = 2_000_000, 100_000

# Classes of bytes: white space, letters, digits, others, the lead of a Latin letter, bytes
# that continue a character, and those that are left to the library.
_SPACE, _LETTER, _DIGIT, _OTHER, _LEAD, _MORE, _ODD = range(7)
_CLASS = np.full(256, _ODD, np.uint8)
_CLASS[0x80:0xC0] = _MORE
_CLASS[0xC3] = _LEAD
_CLASS[0x21:0x7F] = _OTHER
_CLASS[[*range(9, 14), 32]] = _SPACE
_CLASS[[*range(65, 91), *range(97, 123)]] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[ord("'")] = _ODD

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _kinds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, the class of each, and where the split rule is more than classes."""
    kind = _CLASS[data]
    low = _LOWER[data]
    after = np.empty(len(data), np.uint8)
    after[:1], after[1:] = 0, data[:-1]
    latin = after == 0xC3
    odd = (kind == _ODD) | (kind == _MORE) & ~latin | latin & ((data == 0x97) | (data == 0xB7))
    odd |= (data == ord("|")) & (after == ord("<"))
    capital = latin & (data >= 0x80) & (data <= 0x9E)
    low[capital] += 0x20
    kind[(kind == _LEAD) | (kind == _MORE)] = _LETTER
    return low, kind, odd


class ArrayEncoder:
    """Token ids of texts that lie end to end, as one array."""

    def __init__(self, words: WordEncoder):
        self.words = words
        self._clear()

    def _clear(self) -> None:
        self.keys = np.empty(0, U64)  # sorted
        self.at = np.empty(0, np.int64)  # of each key its place in ``starts``
        self.starts, self.sizes, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint16)
        self.recent: dict[int, int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []  # sizes and ids not yet in the arrays
        self.count = self.total = 0

    def _merge(self) -> None:
        if not self.recent:
            return
        keys = np.concatenate([self.keys, np.fromiter(self.recent.keys(), U64, len(self.recent))])
        at = np.concatenate([self.at, np.fromiter(self.recent.values(), np.int64, len(self.recent))])
        order = np.argsort(keys, kind="stable")
        self.keys, self.at, self.recent = keys[order], at[order], {}

    def _settle(self) -> None:
        """Sizes and ids of words learned since, at the end of the arrays."""
        if self.parts:
            sizes = np.concatenate([self.sizes, *(s for s, _ in self.parts)])
            self.ids = np.concatenate([self.ids, *(i for _, i in self.parts)])
            self.sizes, self.starts, self.parts = sizes, np.cumsum(sizes) - sizes, []

    def _places(self, keys: np.ndarray) -> np.ndarray:
        """Of each key its place in ``starts``, or -1."""
        out = np.full(len(keys), -1, np.int64)
        if len(self.keys):
            near = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[near] == keys
            out[hit] = self.at[near[hit]]
        if self.recent:
            open_ = np.flatnonzero(out < 0)
            get = self.recent.get
            out[open_] = [get(k, -1) for k in keys[open_].tolist()]
        return out

    def _learn(self, keys: list[int], texts: list[str]) -> np.ndarray:
        sizes, ids = self.words.encode_words(texts)
        places = np.arange(self.count, self.count + len(keys))
        self.recent.update(zip(keys, places.tolist()))
        self.parts.append((sizes, ids))
        self.count += len(keys)
        return places

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end (16 bits each), and how many each text has."""
        low, kind, odd = _kinds(data)
        slow = by_text(odd, offs) > 0
        n = len(data)
        edge = np.ones(n + 1, bool)  # a word cannot go on over these
        edge[1:n] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        edge[offs] = True
        starts = np.flatnonzero((kind != _SPACE) & edge[:n])
        ends = np.flatnonzero((kind != _SPACE) & edge[1:]) + 1
        if slow.any():
            text = np.searchsorted(offs, starts, "right") - 1
            starts, ends = starts[~slow[text]], ends[~slow[text]]
        first = np.searchsorted(starts, offs)
        codes, keys = pd.factorize(hash_words(low, starts, ends))
        keys = keys.astype(U64)
        if self.count + len(keys) > KEEP:
            self._clear()
        places = self._places(keys)
        new = np.flatnonzero(places < 0)
        if len(new):
            seen = np.empty(len(keys), np.int64)
            seen[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)  # where each comes first
            raw, a, b = low.tobytes(), starts[seen[new]].tolist(), ends[seen[new]].tolist()
            places[new] = self._learn(keys[new].tolist(), [raw[i:j].decode() for i, j in zip(a, b)])
            self._settle()
            if len(self.recent) > MERGE:
                self._merge()
        sizes = self.sizes[places][codes]
        begin = self.starts[places][codes]
        run = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=run[1:])
        ids = self.ids[np.repeat(begin - run[:-1], sizes) + np.arange(run[-1])]
        counts = np.diff(run[first])
        return self._with_slow(data, offs, slow, ids, counts) if slow.any() else (ids, counts)

    def _with_slow(
        self, data: np.ndarray, offs: np.ndarray, slow: np.ndarray, ids: np.ndarray, counts: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        raw, which = data.tobytes(), np.flatnonzero(slow).tolist()
        done = self.words.encode([raw[offs[i] : offs[i + 1]].decode() for i in which])
        more = counts.copy()
        more[which] = [len(d) // 2 for d in done]
        ahead = np.cumsum(more) - more
        out = np.empty(int(more.sum()), np.uint16)
        out[np.arange(len(ids)) + np.repeat(ahead - (np.cumsum(counts) - counts), counts)] = ids
        for i, d in zip(which, done):
            out[ahead[i] : ahead[i] + more[i]] = np.frombuffer(d, "<u2")
        return out, more


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with one more id after each text."""
    more = counts + 1
    last = np.cumsum(more) - 1
    out = np.full(int(more.sum()), end, np.uint16)
    keep = np.ones(len(out), bool)
    keep[last] = False
    out[keep] = ids
    return out, more


def binaries(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Stretches of ``values`` of so many items each, as a column of their bytes."""
    offs = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts * values.itemsize, out=offs[1:])
    data = pa.py_buffer(np.ascontiguousarray(values))
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offs), data])


def flat(column: pa.Array, kind: str) -> np.ndarray:
    """All bytes of a binary column without nulls, end to end."""
    offs = np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: len(column) + 1]
    data = column.buffers()[2]
    if data is None or offs[0] == offs[-1]:
        return np.empty(0, kind)
    return np.frombuffer(data, np.uint8)[offs[0] : offs[-1]].view(kind)


@cache
def array_encoder(path: str) -> ArrayEncoder:
    """One for each worker process, used from task to task."""
    return ArrayEncoder(encoder(path))
