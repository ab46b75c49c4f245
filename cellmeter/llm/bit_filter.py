"""A bit filter of fixed size: what it stops isn't in a set, what it passes may be.

It goes to every worker, so rows can be left out before they are shuffled,
whatever the size of the set; a full filter only stops less.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 16 MB in each worker.
FILTER_BITS = 1 << 27


def filter_bits(hashes: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """Filter of the 64-bit hashes in the one column of ``hashes``.

    At most ``bits / 64`` numbers come to the driver.
    """
    value = F.col(hashes.columns[0])
    cells = (
        hashes.select(
            F.shiftright(value.bitwiseAND(bits - 1), 6).alias("cell"),
            value.bitwiseAND(63).cast("int").alias("place"),
        )
        .select("cell", F.expr("shiftleft(1L, place)").alias("bit"))
        .groupBy("cell")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(bits // 64, np.int64)
    out[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy()
    return out


def passed(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of some unsigned hashes pass."""
    place = hashes & np.uint64(64 * len(bits) - 1)
    cell = bits[(place >> np.uint64(6)).astype(np.int64)].view(np.uint64)
    return (cell >> (place & np.uint64(63))) & np.uint64(1) != 0


def only_passed(rows: DataFrame, key: Column, wanted: DataFrame) -> DataFrame:
    """``rows`` whose 64-bit ``key`` may be in the one column of ``wanted``; all that are stay.

    Only the key goes through Python.
    """
    shared = rows.sparkSession.sparkContext.broadcast(filter_bits(wanted))

    @F.arrow_udf("boolean")
    def passes(keys: pa.Array) -> pa.Array:
        hashes = keys.to_numpy(zero_copy_only=False).view(np.uint64)
        return pa.array(passed(shared.value, hashes))

    return rows.filter(passes(key))
