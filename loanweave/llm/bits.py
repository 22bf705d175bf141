"""A bitmap of bounded size over 64-bit hashes, to leave out early what cannot match.

Its size has a fixed bound, so it may be broadcast: with more hashes it lets more pass, but
never stops one that is in it. Whatever passes is treated exactly afterwards.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the bitmap; 4 MB. Where the hashes are counted first, from 128 KB up to 32 MB.
SIZE = 1 << 25
SMALLEST, LARGEST = 1 << 20, 1 << 28
_PAGE = 15  # bits within one row of Spark's bitmap aggregate


def size_for(hashes: int) -> int:
    """Bits of a bitmap in which so many hashes fill at most one in 32, within the bounds."""
    return min(max(1 << (32 * hashes - 1).bit_length() if hashes else 0, SMALLEST), LARGEST)


def build(hashes: DataFrame, column: str, size: int = SIZE) -> Broadcast:
    """Bitmap of a bigint column, as a broadcast NumPy array. At most ``size / 32768`` rows are collected."""
    bit = F.col(column).bitwiseAND(F.lit(size - 1))
    pages = (
        hashes.where(F.col(column).isNotNull())
        .groupBy(F.shiftright(bit, _PAGE).alias("page"))
        .agg(F.bitmap_construct_agg(bit.bitwiseAND(F.lit((1 << _PAGE) - 1))).alias("bits"))
    )
    out = np.zeros(size // 8, np.uint8)
    width = 1 << (_PAGE - 3)
    for page, bits in pages.collect():
        out[page * width : (page + 1) * width] = np.frombuffer(bytes(bits), np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(out)


def holds(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each hash (unsigned 64-bit), false only if it is not in the bitmap."""
    bit = hashes & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0
