"""Sums of latency results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import ordered_sums

PARTS = ["waiting", "tx", "retx"]


def latency_sums(packets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum of each latency part; zeros where there are no packets."""
    return packets.groupBy(*by).agg(
        *[F.coalesce(F.sum(p), F.lit(0)).cast("bigint").alias(p) for p in PARTS]
    )


def latency_by_batch(packets: DataFrame, numbered: DataFrame) -> DataFrame:
    """One row per numbered batch, zeros for a batch without packets."""
    sums = latency_sums(packets, ["batch_id"])
    return numbered.join(sums, "batch_id", "left").select(
        "batch_no", *[F.coalesce(p, F.lit(0)).cast("bigint").alias(p) for p in PARTS]
    )


def latency_running(by_batch: DataFrame) -> DataFrame:
    """Totals so far after each batch; input has one row per batch."""
    rows = ordered_sums(by_batch, ["batch_no"], {f"{p}_total": F.col(p) for p in PARTS})
    return rows.select("batch_no", *[f"{part}_total" for part in PARTS])


def latency_stack(by_batch: DataFrame) -> DataFrame:
    """Bars stacked in the order waiting, tx, retx: one row per part."""
    bar = lambda part, bottom: F.struct(
        F.lit(part).alias("part"), F.col(part).alias("height"), bottom.alias("bottom")
    )
    zero = F.lit(0).cast("bigint")
    bars = F.array(
        bar("waiting", zero),
        bar("tx", F.col("waiting")),
        bar("retx", F.col("waiting") + F.col("tx")),
    )
    return by_batch.select("batch_no", F.inline(bars))


def block_counts(reports: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """First transmissions and repeats among report records."""
    return reports.groupBy(*by).agg(
        F.count_if("first_tx").alias("cum_block"),
        F.count_if(~F.col("first_tx")).alias("cum_err_block"),
    )
