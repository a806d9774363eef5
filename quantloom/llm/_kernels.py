"""Vectorised text kernels over Arrow string columns (numpy only, bounded memory)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are worked on in slices of about so many bytes; a longer text is a slice of its own.
SLICE = 1 << 20

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
UPPER = np.arange(256, dtype=np.uint8)
UPPER[65:91] += 32  # A-Z to a-z, every other byte as it is


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def slices(at: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each."""
    n, lo = len(at) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi


def words(data: np.ndarray, at: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (byte positions) of the words of all rows, and first word of each row.

    A word is a longest run of bytes that are no separators; rows never share a word.
    """
    inside = ~separators[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0], edge[-1] = True, True
    edge[1:-1] = ~inside[:-1]
    edge[at] = True
    starts = np.flatnonzero(edge[:-1] & inside)
    edge[:-1] |= ~inside
    edge[-1] = True
    ends = np.flatnonzero(edge[1:] & inside) + 1
    return starts, ends, np.searchsorted(starts, at)


def spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All words with one space behind each, and where each word (and the end) lies there."""
    sizes = ends - starts
    at = np.concatenate(([0], np.cumsum(sizes + 1)))
    out = np.full(at[-1], 0x20, np.uint8)
    step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(at[:-1], sizes) + step] = data[np.repeat(starts, sizes) + step]
    return out.tobytes(), at


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            m = max(n, SLICE + 1)
            for name, b in (("up", self.base), ("down", _inverse(self.base))):
                x = np.full(m, b, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))
        return self.up[:n], self.down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a 64-bit value over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTES = Powers(0x9E3779B97F4A7C15)
_WORDS = Powers(0xD1342543DE82EF95)
_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def prefix(values: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of values times powers, from which any range's hash follows."""
    up, down = powers.upto(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return sums, down


def spans_hash(sums: np.ndarray, down: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return mix((sums[hi] - sums[lo]) * down[lo] + (hi - lo).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word."""
    sums, down = prefix(_CODES[data], _BYTES)
    return spans_hash(sums, down, starts, ends)


def word_prefix(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return prefix(hashes, _WORDS)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    out, have = x, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if width > have:
        out = np.minimum(out[: len(out) - (width - have)], out[width - have :])
    return out


def covered(n: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Mask of the positions below ``n`` that lie in some range [lo, hi)."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, lo, 1)
    np.add.at(step, hi, -1)
    return np.cumsum(step[:-1]) > 0
