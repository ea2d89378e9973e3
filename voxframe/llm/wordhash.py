"""Vectorised 64-bit hashes of words and word shingles over the bytes of whole record batches.

A word is a run of bytes other than space and tab to carriage return; A-Z count as a-z.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", BASE), ("down", INVERSE)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without nulls, and the offsets of its rows."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: a polynomial's prefix sums, shifted to each span's start, and the span's length."""
    up, down = _power(len(raw) + 1)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Words:
    """hash, first byte and end byte of every word of a column, and the range of words of each row."""

    def __init__(self, column: pa.Array, space: np.ndarray = _SPACE):
        """`space` says of each byte, after A-Z became a-z, whether it stands between words."""
        raw, offsets = text_bytes(column)
        self.raw = raw = _LOWER[raw]
        inside = np.zeros(len(raw) + 2, dtype=bool)
        inside[1:-1] = ~space[raw]
        edge = inside[1:] != inside[:-1]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(raw))]
        # a word ends where its row ends, even if the next row begins with a word
        touching = np.unique(cuts[inside[cuts] & inside[cuts + 1]]) if len(cuts) else cuts
        starts = np.flatnonzero(edge & inside[1:])
        ends = np.flatnonzero(edge & inside[:-1])
        if len(touching):
            starts, ends = np.sort(np.concatenate([starts, touching])), np.sort(np.concatenate([ends, touching]))
        self.hash = span_hashes(raw, starts, ends)
        self.start, self.end, self.offsets = starts, ends, offsets
        self.rows = np.searchsorted(starts, offsets).astype(np.int64)

    def row(self, i: int) -> np.ndarray:
        return self.hash[self.rows[i] : self.rows[i + 1]]


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-word shingles in order; fewer words give one shingle, no words none."""
    n = len(words)
    if n == 0:
        return np.zeros(0, dtype=np.uint64)
    width = min(k, n)
    x = np.full(n - width + 1, width if n < k else 0, dtype=np.uint64)
    for i in range(width):
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD) + words[i : n - width + 1 + i] * np.uint64(0xC4CEB9FE1A85EC53)
    return mix(x)


def gathered(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of all spans, one span after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def windows(words: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the `width` words from each position on; all windows must end within `words`."""
    up, down = _power(len(words) + 1)
    total = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(mix(words) * up[: len(words)], out=total[1:])
    return mix((total[at + width] - total[at]) * down[at])
