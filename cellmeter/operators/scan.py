"""Ordered scans over sequences of any length.

A window over a whole trace would put the trace into one task. Here a trace is
cut into chunks of a bounded number of rows (consecutive in the order), windows run inside
a chunk, and one small row per chunk carries what earlier or later chunks add.
Only those chunk rows are ever ordered over a whole trace.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from ..staging import stage

FIRST = Window.unboundedPreceding

# Rows of a sequence that one chunk may hold.
CHUNK_ROWS = 1 << 18


def block_of(position: str, chunk_rows: int) -> Column:
    """Chunk number of an integer position."""
    return F.expr(f"`{position}` div {int(chunk_rows)}L")


def chunk_window(keys: Sequence[str], chunk: Sequence[str], order: Sequence) -> WindowSpec:
    """Window inside one chunk, in sequence order."""
    return Window.partitionBy(*keys, *chunk).orderBy(*order)


def earlier_chunks(keys: Sequence[str], chunk: Sequence[str]) -> WindowSpec:
    """The chunk rows before each one of its sequence."""
    return Window.partitionBy(*keys).orderBy(*chunk).rowsBetween(FIRST, -1)


def backward(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    """Window in reverse order.

    "Next value" is the last one met on the way back: Spark grows such a frame
    row by row, while it evaluates a frame that ends at the last row anew for
    every row.
    """
    return Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])


def later_chunks(keys: Sequence[str], chunk: Sequence[str]) -> WindowSpec:
    """The chunk rows after each one, nearest last."""
    return backward(keys, chunk).rowsBetween(FIRST, -1)


def next_value(
    rows: DataFrame,
    keys: Sequence[str],
    chunk: Sequence[str],
    order: Sequence,
    value: Column,
    out: str,
    rank: Column,
) -> DataFrame:
    """First non-NULL ``value`` at or after each row of a sequence.

    ``rank`` is a sortable column that orders the non-NULL values of a chunk as
    ``order`` does.
    """
    onward = backward([*keys, *chunk], order).rowsBetween(FIRST, 0)
    local = rows.withColumn("_local", F.last(value, ignorenulls=True).over(onward))
    per_chunk = rows.groupBy(*keys, *chunk).agg(
        F.min_by(value, F.when(value.isNotNull(), rank)).alias("_chunk_first")
    )
    after = per_chunk.select(
        *keys,
        *chunk,
        F.last("_chunk_first", ignorenulls=True)
        .over(later_chunks(keys, chunk))
        .alias("_after"),
    )
    return (
        local.join(after, [*keys, *chunk])
        .withColumn(out, F.coalesce("_local", "_after"))
        .drop("_local", "_after")
    )


def ordered_sums(
    rows: DataFrame,
    order: Sequence[str],
    values: dict[str, Column],
    by: Sequence[str] = (),
    totals: bool = False,
) -> DataFrame:
    """Inclusive running sums of integer ``values`` over all rows of each group, in order.

    Without groups that is one sequence over the whole table. Rows are sorted by
    ranges, so each task has a stretch of the order; what the stretches before
    add is known from one row per stretch (and group). Rows with the same order
    are in one task. With ``totals`` also ``<name>_all``, the sum over the group.
    """
    by, order, names = list(by), list(order), list(values)
    dealt = rows.withColumns({f"_v_{n}": v.cast("bigint") for n, v in values.items()})
    dealt = dealt.repartitionByRange(*by, *order)
    dealt = stage(dealt.withColumn("_part", F.spark_partition_id()), "ordered")
    here = Window.partitionBy(*by, "_part").orderBy(*order).rowsBetween(FIRST, 0)
    local = dealt.withColumns({n: F.coalesce(F.sum(f"_v_{n}").over(here), F.lit(0)) for n in names})
    stretches = dealt.groupBy(*by, "_part").agg(
        *[F.coalesce(F.sum(f"_v_{n}"), F.lit(0)).alias(n) for n in names]
    )
    if by:
        before = Window.partitionBy(*by).orderBy("_part").rowsBetween(FIRST, -1)
        offsets = stretches.select(
            *by, "_part",
            *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before_{n}") for n in names],
            *[F.sum(n).over(Window.partitionBy(*by)).alias(f"{n}_all") for n in names],
        )
    else:
        offsets = _offsets(stretches, names)
    joined = local.join(offsets, [*by, "_part"]).withColumns(
        {n: F.col(n) + F.col(f"_before_{n}") for n in names}
    )
    ends = [f"{n}_all" for n in names] if totals else []
    return joined.select(*rows.columns, *names, *ends)


def _offsets(stretches: DataFrame, names: list[str]) -> DataFrame:
    """Sums before each stretch and over all; there are as many as partitions of a shuffle."""
    found = sorted(stretches.select("_part", *names).collect())
    alls = [sum(row[n] for row in found) for n in names]
    so_far, rows = [0] * len(names), []
    for row in found:
        rows.append((row["_part"], *so_far, *alls))
        so_far = [s + row[n] for s, n in zip(so_far, names)]
    fields = [T.StructField("_part", T.IntegerType())]
    fields += [T.StructField(f"_before_{n}", T.LongType()) for n in names]
    fields += [T.StructField(f"{n}_all", T.LongType()) for n in names]
    return stretches.sparkSession.createDataFrame(rows, T.StructType(fields))
