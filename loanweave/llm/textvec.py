"""Words of many texts at once, as NumPy arrays over the bytes of an Arrow column.

Nothing here knows Spark: tasks hand in the string column of an Arrow batch. Words are
maximal runs of bytes of one class. Their identity is a 64-bit hash: a sum of the bytes
times one pseudo-random factor per place in the word, then mixed. All arithmetic wraps at
64 bits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_GOLDEN = 0x9E3779B97F4A7C15
_PLACES = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def factors(n: int, seed: int) -> np.ndarray:
    """``n`` odd pseudo-random factors."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_GOLDEN) + np.uint64(seed)
    return mix(steps) | np.uint64(1)


_WEIGHTS = factors(_PLACES, 1)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of 256 truth values, true inside the given inclusive ranges."""
    out = np.zeros(256, dtype=bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


#: Letters and digits of ASCII and every byte of a longer character.
ALNUM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: All but space, tab, line feed, vertical tab, form feed and carriage return.
NOT_BLANK = ~byte_class((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@dataclass
class Words:
    """Words of a range of rows. ``first[i]:first[i+1]`` are the words of row ``i``."""

    data: np.ndarray  # bytes of all texts, one after the other
    bounds: np.ndarray  # first byte of each row, and the end
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return segment_hashes(self.data, self.start, self.end)

    def text(self, begin: int, end: int) -> str:
        """Words ``begin`` to ``end`` with one space between."""
        raw = self.data.data
        return b" ".join(bytes(raw[s:e]) for s, e in zip(self.start[begin:end], self.end[begin:end])).decode(
            "utf-8", "replace"
        )


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts without gaps, and the first byte of each row; NULL is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.int64 if large else np.int32
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def words(texts: pa.Array, member: np.ndarray, lower: bool) -> Words:
    data, bounds = raw_bytes(texts)
    if lower:
        data = LOWER[data]
    inside = member[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True  # a word never crosses from one text to the next
    begins, ends = inside.copy(), np.zeros(len(data) + 1, dtype=bool)
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[1:] = inside
    ends[1:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    return Words(data, bounds, start, end, np.searchsorted(start, bounds))


def segment_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range; ranges are in order, do not overlap and are not empty."""
    if len(start) == 0:
        return np.zeros(0, np.uint64)
    length = end - start
    first = np.zeros(len(start), np.int64)
    np.cumsum(length[:-1], out=first[1:])
    place = np.arange(int(length.sum())) - np.repeat(first, length)
    value = data[place + np.repeat(start, length)].astype(np.uint64) + np.uint64(1)
    if length.max() > _PLACES:  # later places reuse the factors, scrambled once more
        weight = mix(_WEIGHTS[place % _PLACES] + (place // _PLACES).astype(np.uint64))
        weight[place < _PLACES] = _WEIGHTS[place[place < _PLACES]]
    else:
        weight = _WEIGHTS[place]
    value *= weight
    return mix(np.add.reduceat(value, first) + length.astype(np.uint64) * np.uint64(_GOLDEN))


def grams(hashes: np.ndarray, n: int, seed: int = 7) -> np.ndarray:
    """Hash of the ``n`` values from each place on, where that many are left."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(size, np.uint64)
    for j, factor in enumerate(factors(n, seed)):
        out += hashes[j : j + size] * factor
    return mix(out)


def whole_grams(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``grams`` whose words lie in one row, and how many each row has."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    begin = np.repeat(first[:-1], counts)
    ahead = np.zeros(len(counts), np.int64)
    np.cumsum(counts[:-1], out=ahead[1:])
    return begin + np.arange(int(counts.sum())) - np.repeat(ahead, counts), counts


def by_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each row; rows may be empty."""
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
