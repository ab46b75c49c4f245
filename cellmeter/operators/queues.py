"""One-to-one matching of two queues on a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import CHUNK_ROWS, block_of, chunk_window, earlier_chunks


def unmatched(
    rows: DataFrame,
    keys: Sequence[str],
    side: str = "side",
    order: str = "seq",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Entries of sides 1 and 2 that never find a partner with their key.

    Each arrival takes the oldest waiting partner of the other side, so the
    n-th entries of both sides meet, and what is left over on a key is every
    entry whose number is beyond the size of the other side.
    """
    keys = list(keys)
    chunk = [*keys, side, "_block"]
    blocked = rows.withColumn("_block", block_of(order, chunk_rows))
    local = blocked.withColumn(
        "_n", F.row_number().over(chunk_window([*keys, side], ["_block"], [order]))
    )
    per_chunk = blocked.groupBy(*chunk).agg(F.count("*").alias("_rows"))
    sizes = per_chunk.groupBy(*keys).agg(
        F.sum(F.when(F.col(side) == 1, F.col("_rows")).otherwise(0)).alias("_n1"),
        F.sum(F.when(F.col(side) == 2, F.col("_rows")).otherwise(0)).alias("_n2"),
    )
    # Only chunks that reach beyond the other side's size are joined to their rows.
    before = F.sum("_rows").over(earlier_chunks([*keys, side], ["_block"]))
    surplus = (
        per_chunk.withColumn("_before", F.coalesce(before, F.lit(0)))
        .join(sizes, keys)
        .withColumn("_other", F.when(F.col(side) == 1, F.col("_n2")).otherwise(F.col("_n1")))
        .filter(F.col("_before") + F.col("_rows") > F.col("_other"))
        .select(*chunk, "_before", "_other")
    )
    return (
        local.join(surplus, chunk)
        .withColumn("rank", F.col("_before") + F.col("_n"))
        .filter(F.col("rank") > F.col("_other"))
        .select(*rows.columns, "rank")
    )
