"""First-in-first-out matching of arriving packets and queue drains.

Bytes enter and leave in order, so packet and drain meet on the byte axis: a
packet that ends at byte ``hi`` is finished by the first drain whose running
total reaches ``hi``. The match is a sort-merge "next drain at or after" on that
axis. To keep tasks bounded the axis is cut at every byte count where a chunk
of the sequence ends, on the arriving and on the draining side; between two
neighbouring cuts lie at most one chunk of arrivals and one chunk of drains.

A packet begins where the one before it ends, so its first byte needs no search:
it is stamped by the drain that finished the packet before or, if the queue was
empty, by the drain after that one. Each packet is one point of the axis, and
carries the next two drains from there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.radio import circular_diff
from .scan import CHUNK_ROWS, FIRST, backward, block_of, chunk_window, earlier_chunks, later_chunks

_PACKET, _DRAIN, _CUT = 0, 1, 2
_ARRIVING, _DRAINING = 0, 1

_STAMP = "struct<seq:bigint,t:int>"


def _points(moves: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Points on the byte axis: end of each packet, total of each drain."""
    arrives = F.col("delta") > 0
    return moves.select(
        *keys,
        "block",
        F.struct("seq", "t", "delta", "arrived", "drained", "first").alias("move"),
        F.when(arrives, _ARRIVING).otherwise(_DRAINING).alias("side"),
        F.when(arrives, _PACKET).otherwise(_DRAIN).alias("role"),
        F.when(arrives, F.col("arrived")).otherwise(F.col("drained")).alias("byte"),
    )


def _cuts(moves: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cuts of the byte axis, each placed into the chunks that contain it."""
    ends = moves.groupBy(*keys, "block").agg(
        F.max(F.when(F.col("delta") > 0, F.col("arrived"))).alias("arrived"),
        F.max(F.when(F.col("delta") < 0, F.col("drained"))).alias("drained"),
    )
    cuts = (
        ends.select(
            *keys,
            F.inline(
                F.array(
                    F.struct(
                        F.col("arrived").alias("byte"),
                        F.when(F.col("arrived").isNotNull(), F.col("block")).alias("a"),
                        F.lit(None).cast("bigint").alias("d"),
                    ),
                    F.struct(
                        F.col("drained").alias("byte"),
                        F.lit(None).cast("bigint").alias("a"),
                        F.when(F.col("drained").isNotNull(), F.col("block")).alias("d"),
                    ),
                )
            ),
        )
        .filter(F.col("byte").isNotNull())
        .groupBy(*keys, "byte")
        .agg(F.max("a").alias("a"), F.max("d").alias("d"))
    )
    onward = backward(keys, ["byte"]).rowsBetween(FIRST, 0)
    placed = cuts.select(
        *keys,
        "byte",
        F.last("a", ignorenulls=True).over(onward).alias("a_block"),
        F.last("d", ignorenulls=True).over(onward).alias("d_block"),
    )
    return placed.select(
        *keys,
        "byte",
        F.inline(
            F.array(
                F.struct(F.lit(_ARRIVING).alias("side"), F.col("a_block").alias("block")),
                F.struct(F.lit(_DRAINING).alias("side"), F.col("d_block").alias("block")),
            )
        ),
    ).filter(F.col("block").isNotNull())


def _pair(one: Column, two: Column) -> Column:
    return F.struct(one.alias("one"), two.alias("two"))


def _completed(local: Column, after: Column) -> Column:
    """The next two drains, of which those of a segment may be fewer, then those after it."""
    one, two = local.getField("one"), local.getField("two")
    later_one, later_two = after.getField("one"), after.getField("two")
    return _pair(
        F.coalesce(one, later_one),
        F.when(one.isNull(), later_two).otherwise(F.coalesce(two, later_one)),
    )


def _carried(local: DataFrame, keys: list[str]) -> DataFrame:
    """Per segment the next two drains ``after`` it, and those from the end of the packet ``prior`` to it."""
    is_drain, is_packet = F.col("role") == _DRAIN, F.col("role") == _PACKET
    none = F.lit(None).cast(_STAMP)
    segments = local.groupBy(*keys, "segment").agg(
        F.min_by("_next", F.when(is_drain, F.col("byte"))).alias("_begin"),
        F.max_by("_next", F.when(is_packet, F.col("byte"))).alias("_last"),
        F.max(is_packet).alias("_has_packet"),
    )
    later = later_chunks(keys, ["segment"])
    begin = F.col("_begin.one")
    drains = segments.withColumn(
        "_from",
        F.when(
            begin.isNotNull(),
            _pair(begin, F.coalesce("_begin.two", F.last(begin, ignorenulls=True).over(later))),
        ),
    ).withColumn("_after", F.coalesce(F.last("_from", ignorenulls=True).over(later), _pair(none, none)))
    # Before the first packet of all there is no drain, so the next one is the first.
    so_far = chunk_window(keys, [], ["segment"]).rowsBetween(FIRST, 0)
    first = F.coalesce(F.first(begin, ignorenulls=True).over(so_far), F.col("_after.one"))
    ended = F.when(F.col("_has_packet"), _completed(F.col("_last"), F.col("_after")))
    prior = F.last(ended, ignorenulls=True).over(earlier_chunks(keys, ["segment"]))
    return drains.select(
        *keys, "segment", "_after", F.coalesce(prior, _pair(none, first)).alias("_prior")
    )


def match_drains(
    seq: DataFrame,
    keys: Sequence[str] = ("trace_id",),
    chunk_rows: int = CHUNK_ROWS,
    open_packets: DataFrame | None = None,
) -> DataFrame:
    """First drain at or after each packet's start and end byte.

    One row per packet: ``seq, t, delta, arrived, drained`` of its arrival, and
    ``first, done``, each ``struct<seq, t>`` of a drain, NULL where no drain gets
    that far. ``open_packets`` are rows of an earlier result without ``done``.

    With older bytes still queued, the drain that takes the last of them stamps
    the packet's first byte, though it need not take any of it. Into an empty
    queue only a drain that goes beyond the start counts.
    """
    keys = list(keys)
    columns = [*keys, "seq", "t", "delta", "arrived", "drained", "first"]
    moves = seq.filter(F.col("delta") != 0).withColumn("first", F.lit(None).cast(_STAMP))
    moves = moves.select(*columns)
    if open_packets is not None:
        moves = moves.unionByName(open_packets.select(*columns))
    moves = moves.withColumn("block", block_of("seq", chunk_rows))
    cuts = _cuts(moves, keys).withColumn("role", F.lit(_CUT))
    in_chunk = backward([*keys, "side", "block"], ["byte", "role"])
    cut = F.when(F.col("role") == _CUT, F.col("byte"))
    points = (
        _points(moves, keys)
        .unionByName(cuts, allowMissingColumns=True)
        .withColumn(
            "segment",
            F.last(cut, ignorenulls=True).over(in_chunk.rowsBetween(FIRST, 0)),
        )
        .filter(F.col("role") != _CUT)
        .select(*keys, "segment", "byte", "role", "move")
    )
    onward = backward([*keys, "segment"], ["byte", "role"])
    drain = F.when(F.col("role") == _DRAIN, F.struct("move.seq", "move.t"))
    beyond = F.last(drain, ignorenulls=True).over(onward.rowsBetween(FIRST, -1))
    local = (
        points.withColumn("_drain", drain)
        .withColumn("_beyond", beyond)
        .withColumn(
            "_next",
            F.last(
                F.when(F.col("_drain").isNotNull(), _pair(F.col("_drain"), F.col("_beyond"))),
                ignorenulls=True,
            ).over(onward.rowsBetween(FIRST, 0)),
        )
        .drop("_drain", "_beyond")
    )
    packets = (
        local.filter(F.col("role") == _PACKET)
        .join(_carried(local, keys), [*keys, "segment"])
        .withColumn("_next", _completed(F.col("_next"), F.col("_after")))
    )
    before = F.lag("_next").over(chunk_window(keys, ["segment"], ["byte"]))
    backlog = F.col("move.arrived") - F.col("move.delta") > F.col("move.drained")
    return packets.withColumn("_prior", F.coalesce(before, "_prior")).select(
        *keys, "move.seq", "move.t", "move.delta", "move.arrived", "move.drained",
        F.coalesce(
            "move.first", F.when(backlog, F.col("_prior.one")).otherwise(F.col("_prior.two"))
        ).alias("first"),
        F.col("_next.one").alias("done"),
    )


def completed_packets(
    seq: DataFrame,
    keys: Sequence[str] = ("trace_id",),
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Packets fully sent, with waiting and transmit latency.

    ``tx`` counts from the arrival, so it contains ``waiting``.
    """
    return with_latency(match_drains(seq, keys, chunk_rows), keys)


def with_latency(matched: DataFrame, keys: Sequence[str] = ("trace_id",)) -> DataFrame:
    """The packets of ``match_drains`` that are done, with their latencies."""
    return matched.filter(F.col("done").isNotNull()).select(
        *keys,
        "seq",
        F.col("delta").alias("size"),
        F.col("t").alias("t_in"),
        F.col("first.t").alias("t_first"),
        F.col("done.t").alias("t_done"),
        F.col("done.seq").alias("done_seq"),
        circular_diff(F.col("t"), F.col("first.t")).alias("waiting"),
        circular_diff(F.col("t"), F.col("done.t")).alias("tx"),
    )


def last_per_drain(packets: DataFrame, keys: Sequence[str] = ("trace_id",)) -> DataFrame:
    """Of the packets one drain finishes, the one that arrived last.

    All of them share the drain's time slot and each overwrites the one before.
    """
    result = F.max_by(F.struct("waiting", "tx"), "seq")
    return (
        packets.groupBy(*keys, F.col("done_seq").alias("seq"), F.col("t_done").alias("slot"))
        .agg(result.alias("result"))
        .select(*keys, "seq", "slot", "result.waiting", "result.tx")
    )
