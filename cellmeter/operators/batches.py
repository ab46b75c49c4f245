"""Per-batch and whole-run utilization results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import minutes_between
from .scan import ordered_sums


def utilization(samples: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Block total, covered span in whole seconds and its length in minutes.

    An empty input gives an empty table, also for the whole run.
    """
    totals = samples.groupBy(*by).agg(
        F.count("*").alias("_n"),
        F.sum("num_rbs").alias("total_rbs"),
        F.floor(F.min("ts")).alias("min_ts"),
        F.floor(F.max("ts")).alias("max_ts"),
    )
    return totals.filter(F.col("_n") > 0).select(
        *by,
        "total_rbs",
        "min_ts",
        "max_ts",
        minutes_between(F.col("min_ts"), F.col("max_ts")).alias("minutes"),
    )


def number_batches(batches: DataFrame, by: str, has_data: str | None = None) -> DataFrame:
    """Dense numbers from 1, in batch order, for batches with data; one row per batch."""
    if has_data is not None:
        batches = batches.filter(F.col(has_data))
    numbered = ordered_sums(batches, [by], {"batch_no": F.lit(1)})
    return numbered.withColumn("batch_no", F.col("batch_no").cast("int"))


def message_counts(messages: DataFrame, *by: str) -> DataFrame:
    return messages.groupBy(*by).agg(F.count("*").alias("n_messages"))


def new_files(listing: DataFrame, visited: DataFrame, name: str = "file_name") -> DataFrame:
    """Listed files that no run has used."""
    return listing.select(name).distinct().join(visited.select(name), name, "left_anti")


def visited_union(visited: DataFrame, new: DataFrame, name: str = "file_name") -> DataFrame:
    return visited.select(name).union(new.select(name)).distinct()


def last_value(rows: DataFrame, by: Sequence[str], value: str, order: str) -> DataFrame:
    """Newest value per group."""
    return rows.groupBy(*by).agg(F.max_by(value, order).alias("last_value"))
