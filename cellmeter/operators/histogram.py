"""Density histogram with automatic bin width.

The width rule is the one of numpy 2.3 ``bins='auto'``: Freedman-Diaconis,
not below half the square-root width, not above the Sturges width, and at
least 1 for integers.

Values are first reduced to counts per distinct value. Those are sorted by ranges
with running counts, so the quartiles are the values whose running counts hold the
wanted ranks: exact, and no task or buffer sees all distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scan import ordered_sums

_LAYOUT = ["total", "first", "last", "bins", "step"]


def value_counts(rows: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """``value, n`` per group: how often each value occurs. Tables of them add up."""
    return (
        rows.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    )


def auto_histogram(
    rows: DataFrame, value: str, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """``bin, lo, hi, n, density`` per group; empty bins are included.

    ``weight`` names the column that says how many values a row stands for, as in
    ``value_counts``. Without rows there are no bins.
    """
    by = list(by)
    integral = isinstance(rows.schema[value].dataType, T.IntegralType)
    counted = F.count("*") if weight is None else F.sum(weight)
    counts = (
        rows.filter(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("double").alias("x"))
        .agg(counted.alias("c"))
    )
    ranked = ordered_sums(counts, ["x"], {"upto": F.col("c")}, by, totals=True)
    layout = _layout(ranked, by, integral)
    if by:
        placed = ranked.join(layout, by)
    else:
        # One row, or none. Its numbers go into the expressions, so nothing is joined.
        row = layout.first()
        if row is None:
            layout = layout.limit(0)
        placed = ranked.withColumns(
            {f.name: F.lit(row and row[f.name]).cast(f.dataType) for f in layout.schema}
        )
    placed = (
        placed.withColumn("bin", _bin(F.col("x")))
        .groupBy(*by, "bin", *_LAYOUT)
        .agg(F.sum("c").alias("n"))
    )
    return _with_empty_bins(placed, by).select(
        *by,
        "bin",
        _edge(F.col("bin")).alias("lo"),
        _edge(F.col("bin") + 1).alias("hi"),
        "n",
        (F.col("n") / (_edge(F.col("bin") + 1) - _edge(F.col("bin"))) / F.col("total")).alias("density"),
    )


def _quartile(quarter: int) -> Column:
    """The value at a quarter of the ranks, between two values by linear interpolation.

    An aggregate over rows of distinct ``x`` with ``c``, ``upto`` and ``upto_all``.
    """
    place = (F.col("upto_all") - 1) * (quarter / 4.0)
    rank = F.floor(place)

    def at(wanted: Column) -> Column:
        holds = (F.col("upto") - F.col("c") <= wanted) & (wanted < F.col("upto"))
        return F.max(F.when(holds, F.col("x")))

    low = at(rank)
    high = F.coalesce(at(rank + 1), low)
    share = F.max(place - rank)
    # The way numpy interpolates, from the nearer end.
    return F.when(share < 0.5, low + (high - low) * share).otherwise(
        high - (high - low) * (1.0 - share)
    )


def _layout(ranked: DataFrame, by: list[str], integral: bool) -> DataFrame:
    """Number of values, ends, bins and bin width of each group that has values."""
    found = ranked.groupBy(*by).agg(
        F.max("upto_all").alias("total"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
        (_quartile(3) - _quartile(1)).alias("iqr"),
    )
    n, spread = F.col("total"), F.col("max") - F.col("min")
    fd = 2.0 * F.col("iqr") * F.pow(n, F.lit(-1.0 / 3.0))
    width = F.least(
        F.greatest(fd, spread / F.sqrt(n) / 2.0),
        spread / (F.log2(n) + 1.0),
    )
    if integral:
        width = F.greatest(width, F.lit(1.0))
    flat = spread == 0
    return (
        found.filter(n > 0)
        .select(
            *by,
            "total",
            F.when(flat, F.col("min") - 0.5).otherwise(F.col("min")).alias("first"),
            F.when(flat, F.col("max") + 0.5).otherwise(F.col("max")).alias("last"),
            F.when(flat, 1).otherwise(F.ceil(spread / F.when(~flat, width))).cast("int").alias("bins"),
        )
        .withColumn("step", (F.col("last") - F.col("first")) / F.col("bins"))
    )


def _edge(i: Column) -> Column:
    return F.when(i == F.col("bins"), F.col("last")).otherwise(F.col("first") + i * F.col("step"))


def _bin(x: Column) -> Column:
    """Bin of a value, put right where rounding took it over an edge."""
    share = (x - F.col("first")) / (F.col("last") - F.col("first"))
    guess = F.least(F.floor(share * F.col("bins")), F.col("bins") - 1).cast("int")
    return (
        F.when(x < _edge(guess), guess - 1)
        .when((x >= _edge(guess + 1)) & (guess < F.col("bins") - 1), guess + 1)
        .otherwise(guess)
    )


def _with_empty_bins(placed: DataFrame, by: list[str]) -> DataFrame:
    """Every bin of every group; ``placed`` has those with values.

    The first bin always has one, the group's least; its row gives a row with 0
    for every bin, which are added to those with values.
    """
    empty = placed.filter("bin = 0").select(
        *by, F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin"), *_LAYOUT,
        F.lit(0).cast("bigint").alias("n"),
    )
    return (
        placed.select(*by, "bin", *_LAYOUT, "n")
        .unionByName(empty)
        .groupBy(*by, "bin", *_LAYOUT)
        .agg(F.sum("n").alias("n"))
    )
