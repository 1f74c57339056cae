"""Sets of 64-bit hashes as broadcast bitmaps, to leave rows out before a shuffle.

A bitmap has at most 2**MAX_BITS bits (32 MB). A set bit without a member costs
time, never correctness: whoever filters by a bitmap joins exactly afterwards.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BITS = 28


class Bitmap:
    """The leading `bits` bits of the hashes that are in."""

    def __init__(self, bits: int, data):
        self.bits, self.data = bits, data

    def has(self, h: np.ndarray) -> np.ndarray:
        spot = h.view(np.uint64) >> np.uint64(64 - self.bits)
        return (np.frombuffer(self.data.value, np.uint8)[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def destroy(self) -> None:
        """Executors drop it; only when no plan that uses it is left to run."""
        self.data.destroy()


def bits_for(members: float) -> int:
    """Bits at which one foreign hash in eight is taken for a member, as far as MAX_BITS go."""
    return min(MAX_BITS, max(16, math.ceil(math.log2(max(2, 8 * members)))))


def bitmap(hashes: DataFrame, column: str, bits: int) -> Bitmap:
    """Built on the executors: the driver gets 2**bits / 8 bytes, whatever the rows."""
    spot = F.shiftrightunsigned(F.col(column), 64 - bits) + 1
    rows = hashes.select(spot.alias("v")).groupBy(F.bitmap_bucket_number("v").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("part")).collect()
    out = bytearray(1 << (bits - 3))
    for r in rows:
        start = (r.bucket - 1) * 4096
        part = bytes(r.part)[: len(out) - start]
        out[start : start + len(part)] = part
    return Bitmap(bits, hashes.sparkSession.sparkContext.broadcast(bytes(out)))
