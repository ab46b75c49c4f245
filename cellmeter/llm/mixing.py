"""Mix sources to target weights with hash-threshold histograms.

Each document has a hash that no one chooses. A source gives whole passes over
all its documents, and for the rest of its target those with the least hashes:
the threshold is found in a histogram of words per source and hash bucket, then
in one of the boundary bucket alone, and so on until the bucket can't be split.
Documents are filtered by the threshold and never sorted. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import stage

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MOST_PASSES = 2
SEED = "mix-1"

# Hex digits of the hash per level: 4,096 buckets a level, five levels.
_DIGITS = 3
_LEVELS = 5

_NO_SOURCE = "source_is_null"


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def document_hash(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """Hex digits that place a document between 0 and 1; the same in every run."""
    named = F.concat_ws(":", F.lit(seed), doc_id.cast("string"), text)
    return F.substring(F.md5(named.cast("binary")), 1, _DIGITS * _LEVELS)


def _code_points(text: Column) -> Column:
    """Sort key that orders strings by code point: UTF-8 bytes do."""
    return F.hex(text.cast("binary"))


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    most_passes: int = MOST_PASSES,
) -> DataFrame:
    """``source, source_size, target`` out of ``source, source_size``.

    Sources by code point, NULL last, have the weights in turn and share
    ``total_share`` of all words. A target stops at ``most_passes`` times the
    size of its source, and the excess goes to the others by weight, until none
    is above. The level of that filling has a closed form: with sources sorted
    by limit over weight, the first k are at their limits, where k is the first
    at which the share of the rest stays below the next limit.
    """
    # One row per source, in a running sum over three columns: the order is total
    # by definition, as the weights repeat along it.
    in_turn = Window.orderBy(F.col("source").isNull(), _code_points(F.col("source")))
    numbered = sizes.withColumn("_turn", (F.row_number().over(in_turn) - 1) % len(weights))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("_turn") + 1)
    weighed = numbered.select(
        "source",
        "source_size",
        weight.cast("double").alias("_weight"),
        (F.col("source_size") * most_passes).cast("double").alias("_limit"),
    )
    by_level = Window.orderBy(
        F.col("_limit") / F.col("_weight"), F.col("source").isNull(), _code_points(F.col("source"))
    )
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = weighed.select(
        "*",
        F.coalesce(F.sum("_limit").over(before), F.lit(0.0)).alias("_filled"),
        F.coalesce(F.sum("_weight").over(before), F.lit(0.0)).alias("_used"),
        F.sum("_weight").over(everything).alias("_weights"),
        (F.sum("source_size").over(everything) * total_share).alias("_budget"),
    ).withColumn(
        "_level",
        (F.col("_budget") - F.col("_filled")) / (F.col("_weights") - F.col("_used")),
    )
    # The level of the first source that does not reach its limit holds for all after it.
    found = F.min(
        F.when(
            F.col("_level") * F.col("_weight") <= F.col("_limit"),
            F.struct(F.col("_used"), F.col("_level")),
        )
    ).over(everything)
    share = found.getField("_level") * F.col("_weight")
    return levels.select(
        "source",
        "source_size",
        F.when(found.isNull(), F.col("_limit"))
        .otherwise(F.least(share, F.col("_limit")))
        .alias("target"),
    )


def _bucket(level: int) -> Column:
    return F.substring("_hash", level * _DIGITS + 1, _DIGITS)


def thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: whole passes and the hash prefix up to which one more is taken.

    ``rows`` has ``_key, _hash, size``. Level by level, only the rows of the
    boundary bucket are counted again. The last bucket can't be split (documents
    of one hash); it is taken if that leaves the source nearer to its target.
    """
    passes = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    open_ = targets.select(
        "_key",
        passes.alias("_passes"),
        (F.col("target") - passes * F.col("source_size")).alias("_left"),
        F.lit("").alias("_prefix"),
    )
    up_to = (
        Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    )
    inside = rows
    for level in range(_LEVELS):
        counted = inside.groupBy("_key", _bucket(level).alias("_bucket")).agg(
            F.sum("size").alias("_words")
        )
        sums = open_.join(
            counted.withColumn("_sum", F.sum("_words").over(up_to)), "_key", "left"
        )
        # The boundary is the first bucket that would pass what is left.
        over = F.col("_sum") > F.col("_left")
        edges = sums.groupBy("_key", "_passes", "_left", "_prefix").agg(
            F.min(F.when(over, F.struct("_bucket", "_words"))).alias("_edge"),
            F.coalesce(F.max(F.when(~over, F.col("_sum"))), F.lit(0)).alias("_below"),
        )
        # Without a boundary a source gives all it has: "g" sorts after every digit.
        open_ = stage(
            edges.select(
                "_key",
                "_passes",
                (F.col("_left") - F.col("_below")).alias("_left"),
                F.col("_edge._words").alias("_edge_words"),
                F.when(F.col("_prefix").endswith("g"), F.col("_prefix"))
                .otherwise(F.concat("_prefix", F.coalesce(F.col("_edge._bucket"), F.lit("g"))))
                .alias("_prefix"),
            ),
            f"mix_level_{level}",
        )
        inside = (
            rows.join(open_.select("_key", "_prefix"), "_key")
            .filter(F.col("_hash").startswith(F.col("_prefix")))
            .drop("_prefix")
        )
    take_last = F.col("_edge_words") - F.col("_left") < F.col("_left")
    return open_.select(
        "_key",
        "_passes",
        "_prefix",
        F.coalesce(take_last, F.lit(False)).alias("_with_last"),
    )


def _source_key(source: Column) -> Column:
    """A prefix keeps NULL apart from a source that is called like its stand-in."""
    return F.coalesce(F.concat(F.lit("s:"), source), F.lit(_NO_SOURCE))


def _plan(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    source_col: str,
    weights: Sequence[int],
    total_share: float,
    most_passes: int,
    seed: str,
) -> tuple[DataFrame, DataFrame]:
    """Narrow rows of the documents, and targets and thresholds per source; both stored."""
    rows = stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            document_hash(F.col(id_col), F.col(text_col), seed).alias("_hash"),
            _source_key(F.col(source_col)).alias("_key"),
        ),
        "mix_rows",
    )
    sizes = rows.groupBy("_key").agg(
        F.first("source").alias("source"), F.sum("size").alias("source_size")
    )
    targets = source_targets(sizes.drop("_key"), weights, total_share, most_passes)
    targets = stage(
        targets.select(_source_key(F.col("source")).alias("_key"), "source_size", "target"),
        "mix_targets",
    )
    edges = thresholds(rows.select("_key", "_hash", "size"), targets)
    # A table on disk has a known size: Spark broadcasts it if it is small and
    # else shuffles, splitting the partitions of a hot source.
    return rows, stage(targets.join(edges, "_key"), "mix_thresholds")


def _copies(hash_: Column, most_passes: int) -> Column:
    own = F.substring(hash_, F.lit(1), F.length("_prefix"))
    once_more = (own < F.col("_prefix")) | ((own == F.col("_prefix")) & F.col("_with_last"))
    copies = F.col("_passes") + F.when(once_more, 1).otherwise(0)
    return F.least(copies, F.lit(most_passes)).cast("bigint")


def mixed_rows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    most_passes: int = MOST_PASSES,
    seed: str = SEED,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` of each row.

    A document is taken ``copies`` times, 0 to ``most_passes``. Repeated rows (id
    and text the same) have one hash and so the same number of copies; a NULL id
    is an id, a NULL text has no words, a NULL source is a source. No rows in, no
    rows out. Other columns of ``docs`` are not read.
    """
    rows, sources = _plan(
        docs, id_col, text_col, source_col, weights, total_share, most_passes, seed
    )
    return (
        rows.join(sources, "_key")
        .withColumn("copies", _copies(F.col("_hash"), most_passes))
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("size") * F.col("copies")).alias("taken"),
        )
    )


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    most_passes: int = MOST_PASSES,
    seed: str = SEED,
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with all its columns."""
    _, sources = _plan(docs, id_col, text_col, source_col, weights, total_share, most_passes, seed)
    key, copies = "_mix_key", "_mix_copies"
    wanted = sources.select(F.col("_key").alias(key), "_passes", "_prefix", "_with_last")
    hash_ = document_hash(docs[id_col], docs[text_col], seed)
    return (
        docs.withColumn(key, _source_key(F.col(source_col)))
        .join(wanted, key)
        .withColumn(copies, _copies(hash_, most_passes))
        .filter(F.col(copies) > 0)
        .withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))
        .select(*[docs[c] for c in docs.columns])
    )
