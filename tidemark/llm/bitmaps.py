"""Sets of 64-bit hashes as bit tables of a fixed size.

A table answers "certainly not in the set" or "perhaps".  Its size is a parameter and does not follow the
data, so it may be broadcast at every scale; a fuller table only lets more rows through to the exact step
that must follow.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 16 MB.
BITS = 1 << 27


def bit_table(hashes: DataFrame, hashed: Column, bits: int = BITS) -> np.ndarray:
    """The low bits of ``hashed`` of all rows, as bytes; ``bits`` is a power of two and at least 32,768."""
    place = hashed.bitwiseAND(F.lit(bits - 1)) + 1
    blocks = (
        hashes.select(F.bitmap_bucket_number(place).alias("block"), F.bitmap_bit_position(place).alias("bit"))
        .groupBy("block")
        .agg(F.bitmap_construct_agg("bit").alias("bytes"))
    )
    table = np.zeros(bits // 8, np.uint8)
    for row in blocks.toLocalIterator():  # bits / 32,768 rows of 4 kB at most
        at = (row["block"] - 1) * 4096
        table[at : at + len(row["bytes"])] = np.frombuffer(row["bytes"], np.uint8)
    return table


def perhaps(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the table may hold."""
    place = hashes.astype(np.uint64) & np.uint64(len(table) * 8 - 1)
    bit = np.left_shift(np.uint8(1), (place & np.uint64(7)).astype(np.uint8))
    return (table[(place >> np.uint64(3)).astype(np.int64)] & bit) != 0
