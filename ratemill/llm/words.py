"""Words and word shingles of whole texts as 64-bit hashes, for a block of texts at a time.

Words are maximal runs of bytes other than 20 and 09 to 0D (hex), after A-Z became a-z. All arithmetic is modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_Q = np.uint64(0xD6E8FEB86659FD93)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers[name]
    if len(have) < n:
        have = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, base, np.uint64))])
        if n <= 4 * BLOCK_BYTES:
            _powers[name] = have
    return have[:n]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a string column end to end, and where each begins; null is empty."""
    column = column.fill_null("").cast(pa.large_binary()) if column.null_count else column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes; a longer text is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of the first word of each text and of the end)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    space = _SPACE[data]
    before, after = np.empty(len(data), bool), np.empty(len(data), bool)
    before[0], before[1:] = True, space[:-1]
    after[-1], after[:-1] = True, space[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = True
    after[inner - 1] = True
    start, end = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    total = np.cumsum(_BYTE[data] * _power("up", _P, len(data)))
    h = total[end - 1]
    later = start > 0
    h[later] -= total[start[later] - 1]
    return mix(h * _power("down", _P_INVERSE, len(data))[start]), np.searchsorted(start, offsets)


def combine(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive words."""
    n = max(0, len(h) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _Q + h[j:j + n]
    return mix(out)


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct k-word shingles; with fewer words the whole sequence as one; without words none."""
    data, offsets = text_buffer(column)
    for lo, hi in blocks(offsets):
        part = offsets[lo:hi + 1] - offsets[lo]
        h, first = word_hashes(data[offsets[lo]:offsets[hi]], part)
        runs = combine(h, k)
        for i in range(hi - lo):
            a, b = int(first[i]), int(first[i + 1])
            if b - a >= k:
                yield np.unique(runs[a:b - k + 1])
            elif b > a:
                yield mix(combine(h[a:b], b - a) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)
