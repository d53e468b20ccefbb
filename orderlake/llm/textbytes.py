"""Vectorised hashing of words and character grams over the UTF-8 bytes of many texts at once.

Texts are laid end to end in one byte array, so numpy works on megabytes at a
time.  All arithmetic is modulo 2**64; word hashes are polynomials over random
byte values followed by a mixing step, so two words collide with a chance of
about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes handled at once; a longer text is handled alone.
CHUNK = 1 << 20

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
#: Letters, digits and all bytes of non-ASCII characters.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base, and of its inverse."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U(27))
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def chunks(texts: list[bytes], size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``size`` bytes together."""
    start = held = 0
    for i, t in enumerate(texts):
        if i > start and held + len(t) > size:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def word_hashes(texts: list[bytes], outside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of texts laid end to end, with A-Z in lower case.

    ``outside`` marks the bytes between words.  Returns (hash, start, end,
    first): places are bytes of the joined texts with one byte between them,
    and ``first[i]`` is the number of the first word of text i (with a last
    entry for the end).
    """
    buf = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    out = outside[buf]
    edge = np.diff(np.concatenate(([True], out, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    power, inverse = powers(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_VALUES[LOWER[buf]] * power[: len(buf)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    at = np.cumsum([0] + [len(t) + 1 for t in texts])
    return hashes, starts, ends, np.searchsorted(starts, at)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words; the last n - 1 entries hold runs past the end and are to be masked."""
    h = np.zeros(len(words), np.uint64)
    for k in range(n):
        part = words[k:] * U(2 * (0x632BE59BD9B4E019 * (k + 1) % 2**62) + 1)
        h[: len(part)] += part ^ (part >> U(29))
    return mix(h)


def byte_grams(buf: np.ndarray) -> np.ndarray:
    """Each run of 8 bytes as one number (no hashing); len(buf) - 7 entries."""
    if len(buf) < 8:
        return np.zeros(0, np.uint64)
    g = buf.astype(np.uint64)
    for k in (1, 2, 4):
        g = g[:-k] | (g[k:] << U(8 * k))
    return g


class Lookup:
    """Which of many numbers are among a set, and where: a bit table first, then binary search."""

    BITS = 22

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys.astype(np.uint64))
        self.table = np.zeros(1 << self.BITS, bool)
        self.table[self._slot(self.keys)] = True

    def _slot(self, x: np.ndarray) -> np.ndarray:
        return (x * _BASE) >> U(64 - self.BITS)

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in x of the members, and their numbers in ``keys``."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.table[self._slot(x)])
        number = np.minimum(np.searchsorted(self.keys, x[at]), len(self.keys) - 1)
        right = self.keys[number] == x[at]
        return at[right], number[right]


class Postings:
    """Inverted index: for each key the rows that hold it."""

    def __init__(self, keys: np.ndarray, *columns: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.lookup = Lookup(keys)
        self.columns = [c[order] for c in columns]
        self.first = np.searchsorted(keys[order], self.lookup.keys)
        self.count = np.diff(np.append(self.first, len(keys)))

    def hits(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """For each member of x and each of its rows: the position in x, and the row's columns."""
        at, number = self.lookup.find(x)
        n = self.count[number]
        pos = np.repeat(at, n)
        inner = np.arange(len(pos)) - np.repeat(np.cumsum(n) - n, n)
        row = np.repeat(self.first[number], n) + inner
        return (pos, *[c[row] for c in self.columns])


def banded_alignment(pattern: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """Least edits to turn the whole pattern into a stretch of text inside a band of diagonals.

    Cell (i, j) is in the band if ``low <= j - i <= high``.  Returns (edits,
    start, end) of the best stretch; the band's width is the only memory.
    """
    m, n, width = len(pattern), len(text), high - low + 1
    far = m + n + 1
    k = np.arange(width)
    j0 = low + k
    cost = np.where((j0 >= 0) & (j0 <= n), 0, far)
    start = np.where((j0 >= 0) & (j0 <= n), j0, 0)
    for i in range(1, m + 1):
        j = i + low + k
        inside = (j >= 0) & (j <= n)
        sub_ok = inside & (j >= 1)
        other = text[np.clip(j - 1, 0, max(n - 1, 0))] != pattern[i - 1] if n else np.ones(width, bool)
        best = np.where(sub_ok, cost + other, far)
        begin = start.copy()
        skip = np.append(cost[1:], far) + 1  # leave out a pattern unit: (i - 1, j) is the next diagonal
        less = skip < best
        best = np.where(less, skip, best)
        begin = np.where(less, np.append(start[1:], 0), begin)
        best = np.where(inside, best, far)
        # Extra text units: a run along the row, by a running minimum of cost - position.
        run = np.minimum.accumulate((best - k) * width + k)
        source = run % width
        cost = np.where(inside, best[source] + k - source, far)
        start = begin[source]
    e = int(np.argmin(cost))
    return int(cost[e]), int(start[e]), int(m + low + e)
