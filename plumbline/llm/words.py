"""Words of a batch of texts as numpy arrays: places, hashes, and the texts they belong to."""

from __future__ import annotations

import numpy as np

from plumbline.llm.common import Rolling, mix, spread

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_class(separators: list[tuple[int, int]]) -> np.ndarray:
    """True for bytes of words; ``separators`` are inclusive ranges of bytes between words."""
    out = np.ones(256, bool)
    for a, b in separators:
        out[a : b + 1] = False
    return out


#: Words of lower-case letters, digits and all characters beyond ASCII.
ALPHANUMERIC = byte_class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
#: Words between blanks, tabs and line ends.
BLANK_SEPARATED = byte_class([(0x20, 0x20), (0x09, 0x0D)])


class Words:
    """Lower-cased (A-Z) words of texts laid end to end; no word spans two texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray):
        self.data = _LOWER[data]
        inside = kind[self.data]
        before = np.zeros(len(data) + 1, bool)
        before[1:] = inside
        cuts = offsets[:-1][offsets[:-1] < len(data)]
        opens = inside & ~before[:-1]
        opens[cuts] = inside[cuts]
        closes = np.zeros(len(data) + 1, bool)
        closes[1:-1] = inside[:-1] & ~inside[1:]
        if len(data):
            closes[-1] = inside[-1]
        edge = offsets[1:][offsets[1:] > 0]
        closes[edge] |= inside[edge - 1]
        self.start, self.end = np.nonzero(opens)[0], np.nonzero(closes)[0]
        #: First word of each text, and the number of words at the end.
        self.first = np.searchsorted(self.start, offsets)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.hash = mix(Rolling(spread(self.data))(self.start, self.end) + (self.end - self.start).astype(np.uint64))
        self._rolling: Rolling | None = None

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every ``k`` words running, and whether they lie in one text."""
        n = max(0, len(self.hash) - k + 1)
        if self._rolling is None:
            self._rolling = Rolling(self.hash)
        at = np.arange(n)
        return mix(self._rolling(at, at + k), k), self.text[:n] == self.text[k - 1 : k - 1 + n]

    def shown(self, i: int, j: int) -> bytes:
        """Words ``i`` to ``j`` joined by blanks."""
        return b" ".join([self.data[a:b].tobytes() for a, b in zip(self.start[i:j], self.end[i:j])])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` neighbours, by doubling."""
    if len(x) < w:
        return x[:0]
    out, have = x, 1
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def winnow(hashes: np.ndarray, ok: np.ndarray, text: np.ndarray, w: int) -> np.ndarray:
    """Places of the leftmost least hash of each ``w`` neighbouring grams of one text."""
    n = len(hashes)
    if n < w:
        return np.zeros(0, np.int64)
    key = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    least = sliding_min(key, w)
    whole = ok[: len(least)] & ok[w - 1 :] & (text[: len(least)] == text[w - 1 : w - 1 + len(least)])
    picked = np.zeros(n, bool)
    picked[(least[whole] & np.uint64(0xFFFFFFFF)).astype(np.int64)] = True
    return np.nonzero(picked)[0]


class HashSet:
    """Membership of many 64-bit hashes: a bitmap first, then a sorted search."""

    BITS = 22

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        self.map = np.zeros(1 << self.BITS, bool)
        self.map[(self.values & np.uint64((1 << self.BITS) - 1)).astype(np.int64)] = True

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Places in ``x`` of values in the set."""
        if not len(self.values):
            return np.zeros(0, np.int64)
        maybe = np.nonzero(self.map[(x & np.uint64((1 << self.BITS) - 1)).astype(np.int64)])[0]
        at = np.minimum(np.searchsorted(self.values, x[maybe]), len(self.values) - 1)
        return maybe[self.values[at] == x[maybe]]
