"""A set of rows as a bitmap of fixed size, to drop most non-members before a shuffle.

Members always pass; others pass by chance, the more the fuller the map is. So it only saves work:
an exact join or check follows it, and the result never depends on the size.
"""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE = 1 << 24  # bits: 2 MB, whatever the number of members


def slot(column, size: int = SIZE) -> Column:
    return F.pmod(F.col(column) if isinstance(column, str) else column, F.lit(size))


def bitmap(numbers: DataFrame, size: int = SIZE) -> np.ndarray:
    """The bitmap of the only column of `numbers`, hashes as longs. At most size / 64 rows come to the driver."""
    at = slot(F.col(f"`{numbers.columns[0]}`"), size)
    words = (
        numbers.filter(F.col(f"`{numbers.columns[0]}`").isNotNull()).select(at.alias("at"))
        .groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(at & 63 AS INT)))").alias("mask"))
        .toArrow()
    )
    out = np.zeros(size // 64, dtype=np.uint64)
    out[words["word"].to_numpy()] = words["mask"].to_numpy().view(np.uint64)
    return out


def member(words, hashes, size: int = SIZE):
    """Whether each hash (numpy uint64 or int64) may be a member."""
    at = (hashes.view(np.uint64) & np.uint64(size - 1)).astype(np.int64)
    return (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
