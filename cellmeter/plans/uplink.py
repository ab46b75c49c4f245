"""Uplink latency: messages to packets with waiting, transmit and repeat latency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.fifo import completed_packets, last_per_drain, match_drains, with_latency
from ..operators.flush import HARQ_RTT, find_flush, released_groups, tag_retransmissions
from ..operators.records import uplink_rows
from ..operators.scan import CHUNK_ROWS
from ..operators.sequence import end_state, sequence
from ..staging import stage


def latency_from_sequence(
    seq: DataFrame,
    keys: Sequence[str] = ("trace_id",),
    chunk_rows: int = CHUNK_ROWS,
    harq_rtt: int = HARQ_RTT,
) -> DataFrame:
    """The steps after the sequence scan; ``seq`` is a stored table, read several times."""
    reports = seq.filter("is_report")
    slots = stage(
        last_per_drain(completed_packets(seq, keys, chunk_rows), keys), "slots"
    )
    groups = released_groups(find_flush(slots, reports, keys, chunk_rows), keys)
    tagged = tag_retransmissions(groups, reports, keys, chunk_rows, harq_rtt)
    return tagged.select(*keys, "slot", "waiting", "tx", "retx", "flush")


def uplink_latency(
    messages: DataFrame,
    keys: Sequence[str] = ("trace_id",),
    chunk_rows: int = CHUNK_ROWS,
    harq_rtt: int = HARQ_RTT,
) -> DataFrame:
    """Packets that were completed and released by a report.

    ``keys`` name the scope of the state: ``trace_id`` for whole traces, or
    ``batch_id, trace_id`` to start anew in each batch.
    """
    rows = uplink_rows(messages, *keys)
    seq = stage(sequence(rows, keys, chunk_rows), "sequence")
    return latency_from_sequence(seq, keys, chunk_rows, harq_rtt).drop("flush")


def uplink_carried(
    rows: DataFrame,
    state: dict[str, DataFrame] | None = None,
    keys: Sequence[str] = ("trace_id",),
    chunk_rows: int = CHUNK_ROWS,
    harq_rtt: int = HARQ_RTT,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Uplink latency of the next rows of known traces.

    ``rows`` are as ``records.uplink_rows`` gives them and follow, in every
    trace, the rows of the calls before. Returns the packets released by these
    rows and the state to hand to the next call, as tables:

    * ``traces``: clock, level and byte counters after the last row;
    * ``packets``: packets that are still in the queue;
    * ``slots``: finished packets that wait for a report, the last per slot;
    * ``repeats``: reported repeats that no release has used, the last per slot.

    All runs together release what one run over all rows does.
    """
    keys = list(keys)
    slot_keys = [*keys, "slot"]
    state = state or {}
    seq = stage(sequence(rows, keys, chunk_rows, state.get("traces")), "sequence")
    # Row numbers go on from the rows before, so chunks are cut as in one run.
    matched = stage(match_drains(seq, keys, chunk_rows, state.get("packets")), "matched")
    slots = last_per_drain(with_latency(matched, keys), keys)
    if "slots" in state:
        slots = slots.unionByName(state["slots"])
    slots = stage(slots, "slots")

    reports = seq.filter("is_report").select(*keys, "seq", "report_time", "first_tx")
    flushed = stage(find_flush(slots, reports, keys, chunk_rows), "flushed")
    groups = released_groups(flushed, keys)
    repeats = reports.filter(~F.col("first_tx")).select(
        *keys, "seq", "first_tx", F.col("report_time").alias("slot")
    )
    if "repeats" in state:
        repeats = repeats.unionByName(state["repeats"].withColumn("first_tx", F.lit(False)))
    tagged = tag_retransmissions(
        groups, repeats.withColumnRenamed("slot", "report_time"), keys, chunk_rows, harq_rtt
    )

    still = slots.join(flushed.select(*keys, "seq"), [*keys, "seq"], "left_anti")
    last = F.max_by(F.struct("seq", "waiting", "tx"), "seq").alias("last")
    used = groups.groupBy(*slot_keys).agg(F.max("flush").alias("used"))
    after = {
        "traces": end_state(seq, keys, state.get("traces")),
        "packets": matched.filter(F.col("done").isNull()).drop("done"),
        "slots": still.groupBy(*slot_keys).agg(last).select(*slot_keys, "last.*"),
        "repeats": repeats.groupBy(*slot_keys)
        .agg(F.max("seq").alias("seq"))
        .join(used, slot_keys, "left")
        .filter(F.col("used").isNull() | (F.col("seq") > F.col("used")))
        .drop("used"),
    }
    return tagged.select(*keys, "slot", "waiting", "tx", "retx"), after
