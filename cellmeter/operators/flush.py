"""Release of finished packets by later transmission reports.

A finished packet waits in the time slot of its completion. A report of time
``r`` releases slot ``t`` when ``t < r``, or when the clock has wrapped
(``t > 1000`` and ``r < 20``). Each packet's release is therefore the first
later report that satisfies this. It is looked up in the packet's own chunk,
then, for what is left, in a tree of the trace's chunk maxima, and last inside
the one later chunk that points to.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..staging import stage
from .nextabove import first_above
from .scan import CHUNK_ROWS, block_of, next_value

# Wrap thresholds and the retransmission penalty in subframes.
WRAP_SLOT = 1000
WRAP_REPORT = 20
HARQ_RTT = 8

_ALWAYS, _NEVER = 2**31 - 1, -(2**31)

# Rows a task searches at once; a larger chunk is searched whole.
_PIECE_ROWS = 1 << 16

# Nodes per group of the tree of chunk maxima.
_FAN = 64


def _reach(time: Column, slot_wraps: bool) -> Column:
    """Every slot below this value is released by a report of that time."""
    if not slot_wraps:
        return time
    return F.when(time < WRAP_REPORT, F.lit(_ALWAYS)).otherwise(time)


def _release_rows(table: pa.Table) -> pa.Table:
    """Slots of some whole chunks with ``flush``, the releasing report in the chunk.

    Chunks are laid end to end with one entry after each that is above every
    slot, so a search never runs into the next chunk.
    """
    seq, is_report, slot, low, high, starts = (
        table.column(name).to_numpy()
        for name in ("seq", "is_report", "slot", "low", "high", "starts")
    )
    place = np.arange(len(seq)) + np.cumsum(starts) - 1
    size = len(seq) + int(starts.sum())
    report_seq = np.full(size, -1, dtype=np.int64)
    report_seq[place[is_report]] = seq[is_report]
    limit, start = slot[~is_report], place[~is_report] + 1
    longest = int(np.diff(np.append(np.flatnonzero(starts), len(seq))).max()) + 1

    found = np.empty(len(limit), dtype=np.int64)
    wraps = limit > WRAP_SLOT
    for chosen, reach in ((wraps, high), (~wraps, low)):
        line = np.full(size, _ALWAYS, dtype=np.int32)
        line[place] = reach
        found[chosen] = first_above(line, start[chosen], limit[chosen], longest)
    slots = table.filter(pa.array(~is_report)).drop_columns(
        ["is_report", "low", "high", "starts"]
    )
    return slots.append_column("flush", pa.array(report_seq[found]))


def _search_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut a stream of sorted rows at chunk starts and search the pieces."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < _PIECE_ROWS or not batch.column("starts").true_count:
            continue
        table = pa.Table.from_batches(held)
        cut = int(np.flatnonzero(table.column("starts").to_numpy())[-1])
        if cut:
            yield from _release_rows(table.slice(0, cut)).to_batches()
        held = table.slice(cut).to_batches()
        rows = table.num_rows - cut
    if rows:
        yield from _release_rows(pa.Table.from_batches(held)).to_batches()


def _search(slots: DataFrame, reports: DataFrame, chunk: list[str]) -> DataFrame:
    """``slots`` with ``flush``: seq of the first releasing report in the chunk, or -1.

    ``slots`` have ``seq, slot`` and may have more columns, ``reports`` have
    ``seq, low, high``. Of equal ``seq``, reports do not release the slot.
    """
    in_chunk = Window.partitionBy(*chunk).orderBy("seq", F.desc("is_report"))
    marked = (
        slots.withColumns(
            {"is_report": F.lit(False), "low": F.lit(_NEVER), "high": F.lit(_NEVER)}
        )
        .unionByName(
            reports.select(
                *chunk, "seq", "low", "high",
                F.lit(True).alias("is_report"), F.lit(0).alias("slot"),
            ),
            allowMissingColumns=True,
        )
        .withColumn("starts", F.row_number().over(in_chunk) == 1)
    )
    schema = T.StructType([*slots.schema.fields, T.StructField("flush", T.LongType())])
    return marked.mapInArrow(_search_chunks, schema)


def _height(reach: DataFrame, fan: int) -> int:
    """Levels after which every trace has one group, from the largest chunk number."""
    last = reach.agg(F.max("block")).first()[0] or 0
    height = 1
    while last >= fan**height:
        height += 1
    return height


def _tree(reach: DataFrame, keys: list[str], fan: int, height: int) -> DataFrame:
    """Chunk maxima by level: per group of ``fan`` nodes the nodes that have reports, in order.

    A node of one level is a group of the level below; the nodes of level 0 are
    chunks. Stored, so that a small tree is known to be small.
    """
    levels, nodes = [], reach.withColumnRenamed("block", "node")
    for level in range(height):
        groups = nodes.groupBy(*keys, F.expr(f"node div {fan}L").alias("group")).agg(
            F.sort_array(F.collect_list(F.struct("node", "low", "high"))).alias("nodes"),
            F.max("low").alias("low"),
            F.max("high").alias("high"),
        )
        levels.append(groups.select(F.lit(level).alias("level"), *keys, "group", "nodes"))
        nodes = groups.select(*keys, F.col("group").alias("node"), "low", "high")
    return stage(reduce(DataFrame.unionByName, levels), "tree")


def _first_node(after: Column | None) -> Column:
    """First node of a group that reaches above the slot, of those behind ``after``."""

    def releases(node: Column) -> Column:
        reach = F.when(F.col("slot") > WRAP_SLOT, node["high"]).otherwise(node["low"])
        return (reach > F.col("slot")) & (F.lit(True) if after is None else node["node"] > after)

    return F.get(F.filter("nodes", releases), F.lit(0)).getField("node")


def _route(
    open_slots: DataFrame, reach: DataFrame, keys: list[str], fan: int = _FAN
) -> DataFrame:
    """``open_slots`` with ``target``, the first later chunk that releases each.

    Slots that no later chunk reaches are dropped; nothing ever releases them.
    The search goes up the tree of chunk maxima to the first group that has a
    node behind the slot's own that reaches above it, and down again inside that
    node: each step is an equi-join with groups of ``fan`` nodes at most. The tree
    has as many levels as the longest trace needs, so no chunk is out of reach.
    """
    height = _height(reach, fan)
    tree = _tree(reach, keys, fan, height)

    def look(rows: DataFrame, level: int, group: Column, after: Column | None) -> DataFrame:
        groups = tree.filter(F.col("level") == level).select(
            *keys, F.col("group").alias("_group"), "nodes"
        )
        return (
            rows.withColumn("_group", group)
            .join(groups, [*keys, "_group"], "left")
            .withColumn("_node", _first_node(after))
            .drop("nodes", "_group")
        )

    rows = open_slots.select(*keys, "block", "slot").distinct()
    for level in range(height):
        own = F.expr(f"block div {fan**level}L")
        rows = look(rows, level, F.expr(f"block div {fan ** (level + 1)}L"), own)
        rows = rows.withColumnRenamed("_node", f"_up{level}")
    # The lowest level with a node is where the way down begins.
    rows = rows.withColumn("_at", F.lit(None).cast("bigint"))
    for level in reversed(range(height)):
        lower = [F.col(f"_up{below}").isNull() for below in range(level)]
        begins = reduce(lambda x, y: x & y, lower, F.col(f"_up{level}").isNotNull())
        rows = rows.withColumn("_at", F.when(begins, F.col(f"_up{level}")).otherwise(F.col("_at")))
        if level:
            rows = look(rows, level - 1, F.col("_at"), None)
            rows = rows.withColumn("_at", F.col("_node")).drop("_node")
    targets = rows.filter(F.col("_at").isNotNull()).select(
        *keys, "block", "slot", F.col("_at").alias("target")
    )
    return open_slots.join(targets, [*keys, "block", "slot"])


def find_flush(
    slots: DataFrame,
    reports: DataFrame,
    keys: Sequence[str] = ("trace_id",),
    chunk_rows: int = CHUNK_ROWS,
    fan: int = _FAN,
) -> DataFrame:
    """Released slots with ``flush``, the seq of the report that releases them."""
    keys = list(keys)
    chunk = [*keys, "block"]
    slots = slots.select(
        *keys, "seq", "slot", "waiting", "tx",
        block_of("seq", chunk_rows).alias("block"),
        F.col("seq").alias("origin"),
    )
    # A report without a time releases nothing.
    reports = reports.filter(F.col("report_time").isNotNull()).select(
        *keys, "seq", block_of("seq", chunk_rows).alias("block"),
        _reach(F.col("report_time"), False).alias("low"),
        _reach(F.col("report_time"), True).alias("high"),
    )
    columns = [*keys, F.col("origin").alias("seq"), "slot", "waiting", "tx", "flush"]
    local = stage(_search(slots, reports, chunk), "searched")
    reach = stage(
        reports.groupBy(*chunk).agg(F.max("low").alias("low"), F.max("high").alias("high")), "reach"
    )
    open_slots = local.filter(F.col("flush") < 0).drop("flush")
    routed = stage(_route(open_slots, reach, keys, fan), "routed")
    moved = routed.withColumns(
        {"block": F.col("target"), "seq": F.lit(-1).cast("bigint")}
    ).drop("target")
    chosen = moved.select(*chunk).distinct()
    distant = _search(moved, reports.join(chosen, chunk, "left_semi"), chunk)
    return (
        local.filter(F.col("flush") >= 0)
        .select(*columns)
        .unionByName(distant.select(*columns))
    )


def released_groups(flushed: DataFrame, keys: Sequence[str] = ("trace_id",)) -> DataFrame:
    """One result per slot and release; a later completion replaces an earlier one."""
    return (
        flushed.groupBy(*keys, "slot", "flush")
        .agg(F.max_by(F.struct("waiting", "tx"), "seq").alias("result"))
        .select(*keys, "slot", "flush", "result.waiting", "result.tx")
    )


def tag_retransmissions(
    groups: DataFrame,
    reports: DataFrame,
    keys: Sequence[str] = ("trace_id",),
    chunk_rows: int = CHUNK_ROWS,
    harq_rtt: int = HARQ_RTT,
) -> DataFrame:
    """``groups`` with ``retx``: the penalty where a repeat was reported for the slot.

    A repeat counts for the first release of its slot that comes after it.
    """
    keys = list(keys)
    slot_keys = [*keys, "slot"]
    repeats = reports.filter(~F.col("first_tx")).select(
        *keys, F.col("report_time").alias("slot"), "seq"
    )
    marks = groups.select(*slot_keys, F.col("flush").alias("seq"), F.col("flush").alias("release"))
    timeline = marks.unionByName(repeats, allowMissingColumns=True).withColumn(
        "block", block_of("seq", chunk_rows)
    )
    tagged = (
        next_value(
            timeline, slot_keys, ["block"], ["seq"], F.col("release"), "flush", F.col("seq")
        )
        .filter(F.col("release").isNull() & F.col("flush").isNotNull())
        .select(*slot_keys, "flush", F.lit(harq_rtt).alias("retx"))
    )
    return (
        groups.unionByName(tagged, allowMissingColumns=True)
        .groupBy(*slot_keys, "flush")
        .agg(
            F.max("waiting").alias("waiting"),
            F.max("tx").alias("tx"),
            F.coalesce(F.max("retx"), F.lit(0)).alias("retx"),
        )
    )
