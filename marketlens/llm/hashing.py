"""Vectorised 64-bit hashes of words, lines and windows (numpy, one slice of
texts at a time).

A word's hash is a polynomial in random byte values modulo 2**64, taken from
prefix sums so that all words of a slice are hashed at once, then mixed.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
#: Odd multipliers of the polynomials (any odd number will do).
BASE, WINDOW_BASE, WINDOW_BASE_2 = U(0x9E3779B97F4A7C15), U(0xD1342543DE82EF95), U(0xAF251AF3B0F025B5)
#: Bytes whose prefix sums are held at once.
SPAN = 1 << 18
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


BYTES = mix(np.arange(1, 257, dtype=U) * BASE)
LOWER = BYTES.copy()
LOWER[65:91] = BYTES[97:123]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n, kept for the next slice."""
    have = _POWERS.get(int(base))
    if have is None or have[0].size < n:
        size = max(n, SPAN + 1)
        inverse = pow(int(base), -1, 1 << 64)
        up, down = np.full(size, base, U), np.full(size, U(inverse), U)
        up[0] = down[0] = U(1)
        have = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size <= 4 * SPAN:
            _POWERS[int(base)] = have
    return have[0][:n], have[1][:n]


def spans(data: np.ndarray, off: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, bounds): byte ranges between break bytes, and for each
    text i its range bounds[i]:bounds[i + 1] of them.  Texts are
    data[off[i]:off[i + 1]]; an empty range between two breaks is left out."""
    base, part = off[0], data[off[0]:off[-1]]
    gap = breaks[part]
    inner = (off - base)[(off > base) & (off < off[-1])]
    before, after = np.empty_like(gap), np.empty_like(gap)
    if gap.size:
        before[0] = after[-1] = True
        before[1:], after[:-1] = gap[:-1], gap[1:]
        before[inner], after[inner - 1] = True, True
    starts = np.flatnonzero(~gap & before)
    ends = np.flatnonzero(~gap & after) + 1
    return starts + base, ends + base, np.searchsorted(starts, off - base)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = BYTES) -> np.ndarray:
    """64-bit hash of each byte range, in steps of about SPAN bytes."""
    out = np.empty(starts.size, U)
    lo = 0
    while lo < starts.size:
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + SPAN, side="right")))
        a, b = int(starts[lo]), int(ends[hi - 1])
        up, down = powers(BASE, b - a + 1)
        total = np.zeros(b - a + 1, U)
        np.cumsum(table[data[a:b]] * up[:b - a], out=total[1:])
        s, e = starts[lo:hi] - a, ends[lo:hi] - a
        out[lo:hi] = mix((total[e] - total[s]) * down[s] + (e - s).astype(U))
        lo = hi
    return out


def window_hashes(h: np.ndarray, size: int, base: np.uint64 = WINDOW_BASE) -> np.ndarray:
    """Rabin-Karp hash of every ``size`` consecutive values, by prefix sums:
    result i covers h[i:i + size]."""
    n = h.size - size + 1
    if n <= 0:
        return np.zeros(0, U)
    out = np.empty(n, U)
    for lo in range(0, n, SPAN):  # bounded prefix sums, overlapping by size - 1
        part = h[lo:lo + SPAN + size - 1]
        up, down = powers(base, part.size + 1)
        total = np.zeros(part.size + 1, U)
        np.cumsum(part * up[:part.size], out=total[1:])
        m = part.size - size + 1
        out[lo:lo + m] = mix((total[size:] - total[:m]) * down[:m])
    return out


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every ``size`` consecutive values, by doubling."""
    if x.size < size:
        return x[:0]
    width = 1
    while 2 * width <= size:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    rest = size - width
    return np.minimum(x[:x.size - rest], x[rest:]) if rest else x
