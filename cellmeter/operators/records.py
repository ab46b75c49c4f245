"""Nested records to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.radio import fix_report_time, frame_index, last_lcid
from ..functions.timefmt import epoch_seconds
from ..schemas import FIRST_TX, UL_BUFFER, UL_REPORT


def rb_samples(messages: DataFrame, *keep: str) -> DataFrame:
    """One row per downlink record that carries a resource-block count.

    The count is taken out of the records before they are exploded, so a Parquet
    scan reads no other field of them.
    """
    counts = F.col("Records").getField("Num RBs")
    return messages.select(
        *keep,
        epoch_seconds(F.col("ts")).alias("ts"),
        F.explode(counts).alias("num_rbs"),
    ).filter(F.col("num_rbs").isNotNull())


def sequential_rb_samples(
    messages: DataFrame, *keep: str, strict_bound: bool = True
) -> DataFrame:
    """Records whose successor in the message is exactly one subframe later.

    ``strict_bound`` leaves the last pair of a message uncompared.
    """
    records = F.col("Records")

    def index(record: Column) -> Column:
        return frame_index(record.getField("Frame Num"), record.getField("Subframe Num"))

    tail = 2 if strict_bound else 1
    followed = F.filter(
        F.transform(
            records,
            lambda record, i: F.struct(
                i.alias("i"),
                record.getField("Num RBs").alias("num_rbs"),
                (index(F.get(records, i + 1)) - index(record)).alias("step"),
            ),
        ),
        lambda r: (r.getField("i") < F.size(records) - tail) & (r.getField("step") == 1),
    )
    return messages.select(
        *keep,
        epoch_seconds(F.col("ts")).alias("ts"),
        F.explode(followed).alias("r"),
    ).select(*keep, "ts", F.col("r.num_rbs").alias("num_rbs"))


def buffer_samples(messages: DataFrame, *keep: str) -> DataFrame:
    """Subpackets and their samples as rows, positions kept."""
    subpackets = messages.filter(F.col("type_id") == UL_BUFFER).select(
        *keep, F.posexplode("Subpackets").alias("subpacket_pos", "subpacket")
    )
    samples = subpackets.select(
        *keep,
        "subpacket_pos",
        F.posexplode("subpacket.Samples").alias("sample_pos", "sample"),
    )
    channel = last_lcid(F.col("sample.LCIDs"))
    return samples.select(
        *keep,
        "subpacket_pos",
        "sample_pos",
        F.col("sample").getField("Sub FN").alias("sub_fn"),
        F.col("sample").getField("Sys FN").alias("sys_fn"),
        channel.getField("Total Bytes").alias("level"),
    )


def report_records(messages: DataFrame, *keep: str) -> DataFrame:
    """Transmission reports as rows: corrected time and first/repeat mark."""
    records = messages.filter(F.col("type_id") == UL_REPORT).select(
        *keep, F.posexplode("Records").alias("record_pos", "record")
    )
    return records.select(
        *keep,
        "record_pos",
        fix_report_time(F.col("record").getField("Current SFN SF")).alias("report_time"),
        F.col("record").getField("Re-tx Index").eqNullSafe(FIRST_TX).alias("first_tx"),
    )


def uplink_rows(messages: DataFrame, *keep: str) -> DataFrame:
    """Buffer samples and report records of one pass, in replay order columns.

    ``(file_name, msg_seq, pos)`` orders the rows of a trace. ``level`` is NULL
    for reports and for samples without a channel list; ``report_time`` and
    ``first_tx`` are NULL for samples.
    """
    # Samples and records side by side, one of them empty: fields are taken after the
    # explode, not by functions over nested arrays, which Spark doesn't compile.
    report = F.col("type_id") == UL_REPORT

    def only(chosen: Column, items: Column) -> Column:
        return F.coalesce(F.when(chosen, items), F.array())

    samples = F.flatten(F.filter(F.col("Subpackets").getField("Samples"), F.isnotnull))
    items = F.arrays_zip(
        only(~report, samples).alias("sample"),
        only(report, F.col("Records").getField("Current SFN SF")).alias("time"),
        only(report, F.col("Records").getField("Re-tx Index")).alias("index"),
    )
    sample = F.col("item").getField("sample")
    return (
        messages.filter(F.col("type_id").isin(UL_BUFFER, UL_REPORT))
        .select(
            *keep, "file_name", "msg_seq", report.alias("is_report"),
            F.posexplode(items).alias("pos", "item"),
        )
        .select(
            *keep,
            "file_name",
            "msg_seq",
            "pos",
            "is_report",
            sample.getField("Sub FN").alias("sub_fn"),
            sample.getField("Sys FN").alias("sys_fn"),
            last_lcid(sample.getField("LCIDs")).getField("Total Bytes").alias("level"),
            F.when(F.col("is_report"), fix_report_time(F.col("item").getField("time"))).alias(
                "report_time"
            ),
            F.when(
                F.col("is_report"), F.col("item").getField("index").eqNullSafe(FIRST_TX)
            ).alias("first_tx"),
        )
    )


def lines(rows: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per line of a text column."""
    return rows.select(*keep, F.explode(F.split(F.col(text), "\n")).alias("line"))
