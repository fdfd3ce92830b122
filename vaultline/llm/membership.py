"""A set of 64-bit keys as a bitmap of bounded size, for tests inside Python tasks.

The bitmap never loses a key; a foreign key may pass.  Its size follows the
number of keys up to a fixed maximum, so it may be broadcast whatever the
input; beyond that size it only lets more foreign keys pass, which whoever
uses it must settle exactly afterwards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2^28 bits are 32 MB; at least 2^16 bits.
MAX_BITS, MIN_BITS = 28, 16
_BITS_PER_KEY = 16


def bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """Words (uint64) of the bitmap of the long values in ``column``; NULLs are no keys.

    Two bits stand for a key, taken from its low and its high half.  The words
    are combined by Spark; at most 2^22 of them reach the driver.
    """
    values = keys.where(F.col(column).isNotNull()).select(F.col(column).alias("k"))
    count = values.count()
    bits = min(MAX_BITS, max(MIN_BITS, int(count * _BITS_PER_KEY).bit_length()))
    mask = (1 << bits) - 1
    places = F.array(F.col("k").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("k", 32).bitwiseAND(F.lit(mask)))
    words = (
        values.select(F.explode(places).alias("at"))
        .groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 AS int)))").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def contains(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the uint64 ``keys`` pass."""
    mask = np.uint64(len(words) * 64 - 1)
    low, high = keys & mask, (keys >> np.uint64(32)) & mask

    def held(at: np.ndarray) -> np.ndarray:
        return (words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0

    return held(low) & held(high)
