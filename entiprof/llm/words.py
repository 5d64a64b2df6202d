"""Words of UTF-8 bytes and their 64-bit hashes, whole blocks at a time in numpy."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes hashed at once; longer stretches are cut between words.
_SPAN = 1 << 18

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: As BLANK, but ASCII punctuation separates words too.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, U), np.full(n, _INVERSE, U)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def split(data: np.ndarray, bounds: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words, and for each row the index of its first word (one more at the end)."""
    solid = ~blank[data]
    first, last = solid.copy(), solid.copy()
    if len(data):
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        cut = bounds[(bounds > 0) & (bounds < len(data))]
        first[cut] = solid[cut]
        last[cut - 1] = solid[cut - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; equal bytes, equal hash, wherever they stand."""
    out = np.empty(len(starts), U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _SPAN, "right")))
        a, b = starts[i], ends[j - 1]
        n = int(b - a)
        up, down = _powers(_SPAN if n <= _SPAN else n)
        sums = np.zeros(n + 1, U)
        np.cumsum((data[a:b].astype(U) + U(1)) * up[:n], out=sums[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U) * U(0xD6E8FEB86659FD93))
        i = j
    return out


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """The hash of the k words from each position (of len(h) - k + 1), whatever row they belong to."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, U)
    out = h[:n].copy()
    for j in range(1, k):
        out = out * U(0xC2B2AE3D27D4EB4F) + h[j : j + n]
    return mix(out)


def shingle_sets(h: np.ndarray, first: np.ndarray, k: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its k-word shingles; of fewer words, the whole sequence as one."""
    every = runs(h, k)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(every[a : b - k + 1]))
        elif b > a:
            out.append(runs(h[a:b], b - a) + U(b - a))
        else:
            out.append(np.empty(0, U))
    return out


def row_words(data: np.ndarray, bounds: np.ndarray, lower: bool = True, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and each row's first word, for a block of :func:`common.text_blocks`."""
    data = LOWER[data] if lower else data
    starts, ends, first = split(data, bounds, blank)
    return hashes(data, starts, ends), first
