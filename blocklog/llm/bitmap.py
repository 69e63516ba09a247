"""Maps of fixed size that tell tasks which 64-bit keys may be in a table, whatever its size."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 8 MB. A fuller map lets more rows through to the join behind it and loses none.
BITS = 1 << 26


def bitmap(keys: DataFrame, bits: int = BITS) -> np.ndarray:
    """The map with the bit of each key (column `key`) set; at most `bits` / 64 rows come to the driver."""
    slots = bits // 64
    slot = F.expr(f"cast(shiftrightunsigned(key, 6) & {slots - 1} as int)")
    rows = keys.select(slot.alias("slot"), F.expr("shiftleft(1L, cast(key & 63 as int))").alias("bit")).groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    filled = np.zeros(slots, np.uint64)
    filled[rows.column("slot").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return filled


def bitmap_test(keys: DataFrame, bits: int = 1 << 20) -> Callable[[Column], Column]:
    """A test, in the JVM, whether a bigint column may be among the keys (column `key`); never null for a value."""
    filled = ",".join(map(str, bitmap(keys, bits).view(np.int64).tolist()))
    table = F.split(F.lit(filled), ",").cast("array<bigint>")  # folded to a constant

    def test(key: Column) -> Column:
        word = F.get(table, F.shiftrightunsigned(key, 6).bitwiseAND(F.lit(bits // 64 - 1)).cast("int"))
        return F.getbit(word, key.bitwiseAND(F.lit(63)).cast("int")) == 1

    return test


def in_map(keys: np.ndarray, filled: np.ndarray) -> np.ndarray:
    bit = keys.view(np.uint64)
    word = filled[((bit >> np.uint64(6)) & np.uint64(len(filled) - 1)).astype(np.int64)]
    return (word >> (bit & np.uint64(63))) & np.uint64(1) == 1
