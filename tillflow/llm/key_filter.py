"""A set of 64-bit keys as a bitmap of fixed size, for tasks to leave out what cannot be in the set.

A key that is in the set is always found. Others are found by chance, the more
the fuller the bitmap: whoever asks has to be right with all keys let through, and
uses the bitmap to move less. Its size is a constant, whatever the number of keys.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The bitmap has 2 ** BITS bits: 8 MB.
BITS = 26
# Fixed value: bits of one of Spark's bitmaps.
BUCKET_BITS = 15


def key_bit(key: Column) -> Column:
    return F.shiftrightunsigned(key, 64 - BITS)


def bitmap_of(keys: DataFrame, column: str) -> Broadcast:
    """The bitmap of the longs in `column`, as a broadcast numpy array of bytes."""
    bit = key_bit(F.col(column))
    rows = keys.groupBy(F.shiftright(bit, BUCKET_BITS).alias("bucket")).agg(
        F.bitmap_construct_agg(bit.bitwiseAND(F.lit((1 << BUCKET_BITS) - 1))).alias("bits")
    )
    found = np.zeros(1 << (BITS - 3), dtype=np.uint8)
    size = 1 << (BUCKET_BITS - 3)
    for row in rows.toLocalIterator():
        part = np.frombuffer(row["bits"], dtype=np.uint8)
        found[row["bucket"] * size : row["bucket"] * size + len(part)] = part
    return keys.sparkSession.sparkContext.broadcast(found)


def maybe_in(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For every unsigned 64-bit key whether it may be in the set."""
    bit = keys >> np.uint64(64 - BITS)
    return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
