"""Clock, buffer deltas and byte counters along each trace."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.radio import CLOCK_PERIOD, NO_CLOCK, frame_index, is_valid_reading
from ..staging import stage
from .scan import CHUNK_ROWS, FIRST, block_of, chunk_window, earlier_chunks

ORDER = ["file_name", "msg_seq", "pos"]
CHUNK = ["_chunk"]

# Rows are numbered inside units of so many consecutive messages of a file, and
# chunks are cut by row number.
UNIT = ["file_name", "_unit"]
UNIT_MESSAGES = 1 << 12

# Columns of a trace's state after its last row.
STATE = ["seq", "t", "level", "arrived", "drained"]

_SAMPLE, _FIRST_TX, _REPEAT = 0, 1, 2


def sequence(
    rows: DataFrame,
    keys: Sequence[str] = ("trace_id",),
    chunk_rows: int = CHUNK_ROWS,
    start: DataFrame | None = None,
) -> DataFrame:
    """Replay-ordered uplink rows with everything that is a running quantity.

    ``rows`` are as ``records.uplink_rows`` gives them; columns other than those
    are not kept. Added columns:

    * ``seq``: row number in the trace, over samples and reports;
    * ``t``: clock. Every sample ticks once, a valid reading overwrites the
      clock, and -11 stands before the first valid reading. Reports show the
      clock of the sample before them;
    * ``delta``: change of the buffer level against the sample kept before
      (level 0 at the start); NULL where no level was read;
    * ``arrived``, ``drained``: bytes put in and taken out so far.

    A chunk is ``chunk_rows`` consecutive rows, however many a message has and
    however short files are. ``start`` is the ``end_state`` of earlier rows of the
    same traces, if there are any.
    """
    keys = list(keys)
    here = chunk_window(keys, CHUNK, ["seq"])
    so_far, before = here.rowsBetween(FIRST, 0), here.rowsBetween(FIRST, -1)

    # One value column, a kind, and chunk columns without NULLs: the rows and the
    # chunk table below then need exactly the same input, and Spark shuffles it
    # once for both. Stored, as the counts of units need other columns: making the
    # rows out of messages costs more than reading them back.
    packed = rows.select(
        *keys,
        F.coalesce("file_name", F.lit("")).alias("file_name"),
        "msg_seq",
        "pos",
        F.when(~F.col("is_report"), _SAMPLE)
        .when(F.col("first_tx"), _FIRST_TX)
        .otherwise(_REPEAT)
        .alias("_kind"),
        "sub_fn",
        "sys_fn",
        F.when(F.col("is_report"), F.col("report_time"))
        .otherwise(F.col("level"))
        .cast("bigint")
        .alias("_value"),
    )
    packed = _numbered(stage(packed, "rows", level=1), keys, start).withColumn(
        "_chunk", F.expr(f"(seq - 1) div {int(chunk_rows)}L")
    )
    sample = F.col("_kind") == _SAMPLE
    level = F.when(sample, F.col("_value"))
    # A reading without a frame number doesn't set the clock.
    read = sample & is_valid_reading(F.col("sub_fn")) & F.col("sys_fn").isNotNull()
    step = level - F.col("_prev_level")

    counted = packed.select(
        "*",
        F.count_if(sample).over(so_far).alias("_ticks"),
        F.last(level, ignorenulls=True).over(before).alias("_prev_level"),
        F.count(level).over(so_far).alias("_kept"),
    )
    local = counted.select(
        "*",
        F.last(
            F.when(
                read,
                F.struct(
                    F.col("_ticks").alias("ticks"),
                    frame_index(F.col("sys_fn"), F.col("sub_fn")).alias("value"),
                ),
            ),
            ignorenulls=True,
        )
        .over(so_far)
        .alias("_reading"),
        F.sum(F.greatest(step, F.lit(0))).over(so_far).alias("_in"),
        F.sum(F.greatest(-step, F.lit(0))).over(so_far).alias("_out"),
    )
    carried = _carried(local, keys, start)

    ticks = F.col("_base_ticks") + F.col("_ticks")
    reading = F.coalesce(_moved(F.col("_reading"), F.col("_base_ticks")), "_base_reading")
    clock = F.pmod(
        reading.getField("value") + ticks - reading.getField("ticks"), F.lit(CLOCK_PERIOD)
    )

    def counter(base: str, inside: str, edge: str) -> Column:
        at_edge = F.when(F.col("_kept") > 0, F.col(edge)).otherwise(0)
        return F.col(base) + F.coalesce(F.col(inside), F.lit(0)) + at_edge

    return local.join(carried, [*keys, *CHUNK]).select(
        *keys,
        *ORDER,
        (~sample).alias("is_report"),
        level.alias("level"),
        F.when(~sample, F.col("_value").cast("int")).alias("report_time"),
        F.when(~sample, F.col("_kind") == _FIRST_TX).alias("first_tx"),
        "seq",
        F.coalesce(clock, F.lit(NO_CLOCK)).cast("int").alias("t"),
        (level - F.coalesce("_prev_level", "_prior_level")).alias("delta"),
        counter("_base_in", "_in", "_edge_in").alias("arrived"),
        counter("_base_out", "_out", "_edge_out").alias("drained"),
    )


def _numbered(rows: DataFrame, keys: list[str], start: DataFrame | None) -> DataFrame:
    """``rows`` with ``seq``, their number in the trace."""
    placed = rows.withColumn("_unit", F.coalesce(block_of("msg_seq", UNIT_MESSAGES), F.lit(-1)))
    units = placed.groupBy(*keys, *UNIT).agg(F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(earlier_chunks(keys, UNIT)), F.lit(0))
    if start is not None:
        units = units.join(start.select(*keys, F.col("seq").alias("_s_seq")), keys, "left")
        before = before + F.coalesce("_s_seq", F.lit(0))
    bases = units.select(*keys, *UNIT, before.alias("_base"))
    inside = F.row_number().over(chunk_window(keys, UNIT, ["msg_seq", "pos"]))
    return (
        placed.withColumn("_inside", inside)
        .join(bases, [*keys, *UNIT])
        .withColumn("seq", F.col("_base") + F.col("_inside"))
        .drop("_base", "_inside", "_unit")
    )


def _moved(reading: Column, ticks: Column) -> Column:
    """A chunk's reading with its tick counted from the start of the trace."""
    return F.when(
        reading.isNotNull(),
        F.struct(
            (ticks + reading.getField("ticks")).alias("ticks"),
            reading.getField("value").alias("value"),
        ),
    )


def _carried(local: DataFrame, keys: list[str], start: DataFrame | None) -> DataFrame:
    """What the start state and the earlier chunks of a trace hand to each chunk."""
    no_long = F.lit(None).cast("bigint")
    level_at = F.when((F.col("_kind") == _SAMPLE) & F.col("_value").isNotNull(), F.col("seq"))
    summary = local.groupBy(*keys, *CHUNK).agg(
        F.max("_ticks").alias("_ticks"),
        F.max("_reading").alias("_reading"),
        F.min_by("_value", level_at).alias("_first"),
        F.max_by("_value", level_at).alias("_last"),
        F.coalesce(F.max("_in"), F.lit(0)).alias("_in"),
        F.coalesce(F.max("_out"), F.lit(0)).alias("_out"),
    )
    if start is None:
        summary = summary.withColumns(
            {"_s_t": F.lit(NO_CLOCK), "_s_level": no_long,
             "_s_arrived": no_long, "_s_drained": no_long}
        )
    else:
        state = start.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in STATE if c != "seq"])
        summary = summary.join(state, keys, "left")
    past = earlier_chunks(keys, CHUNK)

    def total(column: Column, initial: str | None = None) -> Column:
        before = F.coalesce(F.sum(column).over(past), F.lit(0))
        return before + F.coalesce(F.col(initial), F.lit(0)) if initial else before

    clock = F.when(
        F.col("_s_t") != NO_CLOCK,
        F.struct(F.lit(0).cast("bigint").alias("ticks"), F.col("_s_t").alias("value")),
    )
    edge = F.coalesce(F.col("_first") - F.col("_prior_level"), F.lit(0))
    bases = summary.select(
        "*",
        total(F.col("_ticks")).alias("_base_ticks"),
        F.coalesce(
            F.last("_last", ignorenulls=True).over(past), F.col("_s_level"), F.lit(0)
        ).alias("_prior_level"),
    ).select(
        "*",
        F.greatest(edge, F.lit(0)).alias("_edge_in"),
        F.greatest(-edge, F.lit(0)).alias("_edge_out"),
        _moved(F.col("_reading"), F.col("_base_ticks")).alias("_moved"),
    )
    return bases.select(
        *keys,
        *CHUNK,
        "_base_ticks",
        "_prior_level",
        "_edge_in",
        "_edge_out",
        F.coalesce(F.last("_moved", ignorenulls=True).over(past), clock).alias("_base_reading"),
        total(F.col("_in") + F.col("_edge_in"), "_s_arrived").alias("_base_in"),
        total(F.col("_out") + F.col("_edge_out"), "_s_drained").alias("_base_out"),
    )


def end_state(
    seq: DataFrame, keys: Sequence[str] = ("trace_id",), start: DataFrame | None = None
) -> DataFrame:
    """State of every trace after ``seq``; traces without new rows keep theirs."""
    rows = seq.select(*keys, *STATE)
    if start is not None:
        rows = rows.unionByName(start)
    level_at = F.when(F.col("level").isNotNull(), F.col("seq"))
    return rows.groupBy(*keys).agg(
        F.max_by("t", "seq").alias("t"),
        F.max_by("level", level_at).alias("level"),
        F.max("arrived").alias("arrived"),
        F.max("drained").alias("drained"),
        F.max("seq").alias("seq"),
    )


def arrivals(seq: DataFrame, keys: Sequence[str] = ("trace_id",)) -> DataFrame:
    """Packets put into the queue, with the byte range each one covers."""
    return seq.filter(F.col("delta") > 0).select(
        *keys,
        "seq",
        F.col("t").alias("t_in"),
        F.col("delta").alias("size"),
        (F.col("arrived") - F.col("delta")).alias("lo"),
        F.col("arrived").alias("hi"),
        "drained",
    )


def departures(seq: DataFrame, keys: Sequence[str] = ("trace_id",)) -> DataFrame:
    """Drains of the queue, with the bytes sent up to and with each one."""
    return seq.filter(F.col("delta") < 0).select(
        *keys, "seq", "t", (-F.col("delta")).alias("sent"), "drained"
    )
