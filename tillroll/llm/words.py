"""Flat numpy store of words that were encoded before, so that a word is encoded once per Python worker.

A text is an array of code points and the places where its words start. Words are told apart by two independent
64-bit hashes; those not in the store are handed to the encoder together.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

# Words and ids remembered; beyond either the store starts anew. Longer words than LONGEST are not remembered.
LIMIT, IDS, LONGEST = 1_000_000, 8_000_000, 64
# Code points handled at once; a longer text is handled alone.
SLICE = 1 << 20

Encoder = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def groups(texts: list[str]):
    """(first, last) ranges of texts with about SLICE code points."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= SLICE:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of all ranges in turn."""
    total = np.cumsum(sizes)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(starts - (total - sizes), sizes)


class WordStore:
    """``encode(code points, sizes)`` gives the ids of words in turn and how many each has."""

    def __init__(self, encode: Encoder, kind: np.dtype) -> None:
        self.encode, self.kind = encode, np.dtype(kind)
        self._power = np.ones((2, 1), np.uint64)
        self.clear()

    def clear(self) -> None:
        self.first = np.zeros(0, np.uint64)  # sorted
        self.second = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int32)
        self.ids = np.zeros(0, self.kind)

    def _hashes(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        longest = int(sizes.max())
        if self._power.shape[1] < longest:
            base = np.array([[0x9E3779B97F4A7C15], [0xD6E8FEB86659FD93]], np.uint64)
            self._power = np.multiply.accumulate(np.repeat(base, 2 * longest, axis=1), axis=1)
        place = np.arange(len(codes)) - np.repeat(starts, sizes)
        c = codes.astype(np.uint64)
        out = []
        for k, mix in enumerate((0xBF58476D1CE4E5B9, 0x94D049BB133111EB)):
            value = (c + np.uint64(k + 1)) * np.uint64(mix)
            value ^= value >> np.uint64(29)
            value *= self._power[k][place]
            total = np.add.reduceat(value, starts)
            out.append(total ^ (total >> np.uint64(31)))
        return out

    def look_up(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in turn, and how many each has."""
        sizes = np.diff(np.append(starts, len(codes)))
        short = sizes <= LONGEST
        if short.all():
            return self._stored(codes, starts)
        counts = np.zeros(len(starts), np.int64)
        some = sizes[short]
        known, counts[short] = self._stored(codes[ranges(starts[short], some)], np.cumsum(some) - some)
        new, counts[~short] = self.encode(codes[ranges(starts[~short], sizes[~short])], sizes[~short])
        at = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), self.kind)
        out[ranges(at[short], counts[short])] = known
        out[ranges(at[~short], counts[~short])] = new
        return out, counts

    def _stored(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(starts):
            return np.zeros(0, self.kind), np.zeros(0, np.int64)
        sizes = np.diff(np.append(starts, len(codes)))
        first, second = self._hashes(codes, starts, sizes)
        distinct, which, back = np.unique(first, return_index=True, return_inverse=True)
        if not np.array_equal(second[which][back], second):  # two words with one hash: no sharing here
            ids, counts = self.encode(codes, sizes)
            return ids.astype(self.kind), counts
        if len(self.first) > LIMIT or len(self.ids) > IDS:
            self.clear()
        place = np.searchsorted(self.first, distinct)
        found = np.zeros(len(distinct), bool)
        if len(self.first):
            near = np.minimum(place, len(self.first) - 1)
            same = self.first[near] == distinct
            found = same & (self.second[near] == second[which])
            if (same & ~found).any():
                self.clear()
                return self._stored(codes, starts)
        if not found.all():
            new = which[~found]
            ids, counts = self.encode(codes[ranges(starts[new], sizes[new])], sizes[new])
            at = len(self.ids) + np.cumsum(counts) - counts
            self.ids = np.concatenate([self.ids, ids.astype(self.kind)])
            put = place[~found]
            self.at, self.size = np.insert(self.at, put, at), np.insert(self.size, put, counts)
            self.second = np.insert(self.second, put, second[new])
            self.first = np.insert(self.first, put, distinct[~found])
            place = np.searchsorted(self.first, distinct)
        place = place[back]
        counts = self.size[place].astype(np.int64)
        return self.ids[ranges(self.at[place], counts)], counts
