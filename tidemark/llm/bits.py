"""Sets of 64-bit hashes as bits, small enough for every task."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter: as many times the number of hashes in it, but no more than 2 to the largest.
FACTOR, MOST = 16, 27


@dataclass
class Filter:
    """A set of fingerprints as bits at their leading bits; it may hold more, never less."""

    bits: np.ndarray
    size: int

    def holds(self, prints: np.ndarray) -> np.ndarray:
        at = prints >> np.uint64(64 - self.size)
        return ((self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)


def bit_filter(prints: DataFrame, count: int) -> Filter:
    """Filter over the longs of column ``fp``. What reaches the driver is bounded by 2 to the MOST bits."""
    size = min(max(6, (FACTOR * max(count, 1) - 1).bit_length()), MOST)
    at = F.shiftrightunsigned("fp", 64 - size)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(fp, {64 - size}) & 63 AS INT))")
    words = prints.select(F.shiftrightunsigned(at, 6).alias("word"), bit.alias("bit"))
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(1 << (size - 6), np.uint64)
    bits[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return Filter(bits, size)


def parted(rows: DataFrame, key: Column, prints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose long ``key`` may be in column ``fp`` of the stored ``prints``, and those where it is not.

    Only the former, few more than there are matches, then need to be shuffled for a join, however large both sides are.
    """
    known = rows.sparkSession.sparkContext.broadcast(bit_filter(prints, prints.count()))

    @F.pandas_udf("boolean")
    def held(keys):
        import pandas as pd

        return pd.Series(known.value.holds(keys.to_numpy().view(np.uint64)))

    return rows.filter(held(key)), rows.filter(~held(key))
