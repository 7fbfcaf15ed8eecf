"""Sets of 64-bit keys as bit maps of fixed size, which may hold too much but never too little."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A map takes 2^MAP_BITS bits, whatever it holds; beyond some 10^8 keys it lets most through.
MAP_BITS = 26


def bit_map(keys: DataFrame) -> np.ndarray:
    """One bit for every key of the column `key`, by its first bits; ones are gathered by Spark."""
    placed = keys.select(F.shiftrightunsigned("key", 64 - MAP_BITS).alias("bit"))
    ones = F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 AS int))"))
    words = placed.groupBy(F.shiftright("bit", 6).alias("word")).agg(ones.alias("bits")).toArrow()
    out = np.zeros(1 << (MAP_BITS - 6), np.uint64)
    out[np.asarray(words.column("word"))] = np.asarray(words.column("bits")).view(np.uint64)
    return out


def marked(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys the map holds."""
    place = keys >> np.uint64(64 - MAP_BITS)
    return (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
