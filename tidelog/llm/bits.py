"""A bit set of bounded size that stands in for a semi join.

Tasks ask it which hashes can be in a set; a wrong "yes" only costs a row that
an exact grouping drops later.  It never exceeds 2^MOST bits (32 MiB), whatever
the set: beyond some 10^8 members it just lets more through.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST = 28


class BitSet:
    """Members by ``probes`` places of a 64-bit hash; shipped to tasks as a broadcast array of at most 32 MiB."""

    def __init__(self, handle, log2: int, probes: int) -> None:
        self.handle, self.log2, self.probes = handle, log2, probes

    def maybe(self, hashed: np.ndarray) -> np.ndarray:
        words, out = self.handle.value, None
        for p in range(self.probes):
            at = (hashed >> np.uint64(p * 32)) & np.uint64((1 << self.log2) - 1)
            there = (words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0
            out = there if out is None else out & there
        return out

    def free(self) -> None:
        """Takes the array from driver and tasks; for a set that no unfinished plan asks."""
        self.handle.destroy()


def bit_set(members: DataFrame, column: str, count: int, probes: int = 2) -> BitSet:
    """The bit set of a column of 64-bit hashes; count is about how many members there are.

    Bits are or-ed map-side and by word in the cluster; the driver gets the words only.
    """
    log2 = min(MOST, max(16, (24 * max(count, 1)).bit_length()))
    hashed = F.col(column)
    places = [F.call_function("shiftrightunsigned", hashed, F.lit(p * 32)).bitwiseAND(F.lit((1 << log2) - 1)) for p in range(probes)]
    at = members.select(F.explode(F.array(*places)).alias("at"))
    words = at.groupBy(F.shiftright("at", 6).cast("int").alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))).alias("v"))
    got = words.toArrow()
    array = np.zeros(1 << max(0, log2 - 6), np.uint64)
    array[got.column("w").to_numpy()] = got.column("v").to_numpy().view(np.uint64)
    return BitSet(members.sparkSession.sparkContext.broadcast(array), log2, probes)
