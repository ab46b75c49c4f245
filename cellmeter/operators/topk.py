"""Largest groups, the rest as one row, and the total."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_with_other(
    rows: DataFrame, key: str, size: Column, k: int = 3, exclude: Iterable = ()
) -> DataFrame:
    """``kind, rank, label, n_keys, size``: k top rows, one other row, one total row.

    Ties go to the smaller key. The other row is left out when no key remains.
    """
    excluded = list(exclude)
    if excluded:
        rows = rows.filter(~F.col(key).isin(excluded))
    sums = rows.groupBy(key).agg(F.sum(size).alias("size"))
    top = (
        sums.orderBy(F.desc("size"), key)
        .limit(k)
        .withColumn(
            "rank", F.row_number().over(Window.partitionBy().orderBy(F.desc("size"), key))
        )
        .select(
            F.lit("top").alias("kind"),
            "rank",
            F.col(key).cast("string").alias("label"),
            F.lit(1).cast("bigint").alias("n_keys"),
            "size",
        )
    )
    total = sums.agg(
        F.count("*").alias("n_keys"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")
    ).select(
        F.lit("total").alias("kind"),
        F.lit(None).cast("int").alias("rank"),
        F.lit(None).cast("string").alias("label"),
        "n_keys",
        "size",
    )
    listed = top.unionByName(total)
    sign = F.when(F.col("kind") == "total", 1).otherwise(-1)
    other = (
        listed.agg(
            F.sum(sign * F.col("n_keys")).alias("n_keys"),
            F.sum(sign * F.col("size")).alias("size"),
        )
        .filter(F.col("n_keys") > 0)
        .select(
            F.lit("other").alias("kind"),
            F.lit(None).cast("int").alias("rank"),
            F.lit(None).cast("string").alias("label"),
            "n_keys",
            "size",
        )
    )
    return listed.unionByName(other)
