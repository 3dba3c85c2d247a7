"""Hashes of the words of a text, computed for all words at once."""

from __future__ import annotations

import numpy as np

ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = [np.uint64(c) for c in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit numbers spread evenly, another way for each salt."""
    x = x + np.uint64((salt * 0xD1342543DE82EF95 + 1) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


_FACTOR = 0xD6E8FEB86659FD93
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_PIECE = 1 << 20


class WordHashes:
    """64-bit hashes of the words of a text, all at once.

    A word's hash is a polynomial of its bytes; those of all words come from one running sum over
    the text, divided by the power of the word's place. The powers are kept.
    """

    def __init__(self):
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if size > len(self.powers):
            size = max(size, 2 * len(self.powers))
            for name, factor in (("powers", _FACTOR), ("inverses", _INVERSE)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def __call__(self, data: bytes) -> np.ndarray:
        text = np.frombuffer(data, np.uint8)
        blank = _BLANK[text]
        if len(text) <= _PIECE:
            return self._of(text, blank)
        # Long texts go piece by piece, cut at blanks.
        cuts, at = [0], _PIECE
        blanks = np.flatnonzero(blank)
        while at < len(text):
            k = int(np.searchsorted(blanks, at))
            if k == len(blanks):
                break
            cuts.append(int(blanks[k]))
            at = cuts[-1] + _PIECE
        cuts.append(len(text))
        return np.concatenate([self._of(text[i:j], blank[i:j]) for i, j in zip(cuts, cuts[1:])])

    def _of(self, text: np.ndarray, blank: np.ndarray) -> np.ndarray:
        n = len(text)
        edges = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True]))))
        starts, ends = edges[0::2], edges[1::2]
        if not len(starts):
            return np.zeros(0, np.uint64)
        self._grow(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        terms = text.astype(np.uint64)
        terms += np.uint64(1)
        terms *= self.powers[:n]
        np.cumsum(terms, out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64) * ODD)
