"""Messages derived from the benchmark tables.

The benchmark holds no radio logs, so its ``events`` play them: a user is a
trace, a day is a file and a batch, and the event number is the message number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefmt import utc_instant
from ..schemas import CUSTOM, DL_STAT, FIRST_TX, RECORDS, SUBPACKETS, UL_BUFFER, UL_REPORT

REPORT_EVENTS = ["click", "error"]


# Days of the month that one part of a replayed stream has.
PART_DAYS = 6


def part_of(day: str) -> Column:
    """Number of the part that a day (``YYYY-MM-DD``) belongs to."""
    return F.expr(f"cast((cast(substring(`{day}`, 9, 2) as int) - 1) div {PART_DAYS} as int)")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def envelope(events: DataFrame) -> DataFrame:
    """Event columns plus the message envelope; some events are custom packets."""
    custom = F.col("event_id") % 97 == 0
    return events.select(
        F.col("user_id").cast("string").alias("trace_id"),
        F.col("ts").cast("date").cast("string").alias("file_name"),
        F.col("event_id").alias("msg_seq"),
        F.when(custom, CUSTOM).otherwise(F.col("event_type")).alias("type_id"),
        utc_instant("ts").alias("ts"),
        "event_type",
        F.floor("value").alias("level"),
        "props",
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope(table(spark, sf_dir, "events"))


def _downlink_records() -> Column:
    """Up to five records per event; every fifth lacks its block count."""
    n = F.col("msg_seq")

    def record(i):
        index = n * 7 + i + F.when((n + i) % 4 == 3, 1).otherwise(0)
        blocks = F.when((n + i) % 5 != 0, F.col("level") + i)
        return F.struct(
            (F.floor(index / 10) % 1024).cast("int"),
            (index % 10).cast("int"),
            blocks.cast("int"),
            F.lit(None).cast("int"),
            F.lit(None).cast("string"),
        )

    steps = F.when(n % 6 > 0, F.sequence(F.lit(0).cast("bigint"), n % 6 - 1)).otherwise(
        F.array().cast("array<bigint>")
    )
    return F.transform(steps, record).cast(RECORDS)


def downlink_from(messages: DataFrame) -> DataFrame:
    """Downlink messages out of event messages."""
    return messages.select(
        "trace_id",
        "file_name",
        F.col("file_name").alias("batch_id"),
        "msg_seq",
        F.lit(DL_STAT).alias("type_id"),
        "event_type",
        "ts",
        _downlink_records().alias("Records"),
    )


def downlink_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return downlink_from(event_messages(spark, sf_dir))


def _frame() -> Column:
    """System frame that the readings of an event are near; it wraps every three weeks."""
    phase = F.expr("(dayofmonth(ts) - 1) div 3") * 3 % 7
    return phase * 170


def _some(count: Column) -> Column:
    """0 to ``count - 1``, for counts up to 3."""
    return F.slice(F.array(*[F.lit(i) for i in range(3)]), F.lit(1), count.cast("int"))


def _subpackets(frame: Column) -> Column:
    """0 to 3 subpackets of 0 to 3 samples of 0 to 3 channels each."""
    n = F.col("msg_seq")
    no_long = F.lit(None).cast("bigint")

    def channels(i: Column, j: Column) -> Column:
        return F.transform(
            _some((n + j) % 4),
            lambda k: F.struct(F.col("level") * (k + 1) + i, no_long, no_long, no_long),
        )

    def samples(i: Column) -> Column:
        return F.transform(
            _some((n + i) % 4),
            lambda j: F.struct(
                ((n + i + j) % 16).cast("int"), ((frame + j) % 1024).cast("int"), channels(i, j)
            ),
        )

    return F.transform(_some(n % 4), lambda i: F.struct(samples(i))).cast(SUBPACKETS)


def _reports(frame: Column) -> Column:
    """0 to 3 report records near the clock, some of them before it wraps."""
    n = F.col("msg_seq")
    no_int = F.lit(None).cast("int")
    early = F.when(n % 5 == 0, 20).otherwise(0)
    return F.transform(
        _some(n * 7 % 4),
        lambda j: F.struct(
            no_int, no_int, no_int,
            (frame * 10 + (n + j * 5) % 31 - early).cast("int"),
            F.when((n + j) % 2 == 0, FIRST_TX).otherwise("Second"),
        ),
    ).cast(RECORDS)


def uplink_from(messages: DataFrame) -> DataFrame:
    """Reports and buffer readings out of event messages, each made from its event alone."""
    report = F.col("event_type").isin(REPORT_EVENTS)
    return messages.select(
        "trace_id",
        "file_name",
        F.col("file_name").alias("batch_id"),
        "msg_seq",
        F.when(report, UL_REPORT).otherwise(UL_BUFFER).alias("type_id"),
        "ts",
        F.when(report, _reports(_frame())).alias("Records"),
        F.when(~report, _subpackets(_frame())).alias("Subpackets"),
    )


def nested_buffer_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a buffer message."""
    return event_messages(spark, sf_dir).select(
        "trace_id", "msg_seq", F.lit(UL_BUFFER).alias("type_id"),
        _subpackets(F.expr("msg_seq div 3")).alias("Subpackets"),
    )


def uplink_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uplink_from(event_messages(spark, sf_dir))


def radio_messages(events: DataFrame) -> DataFrame:
    """Both kinds of messages out of events, in one scan: each event gives two."""
    report = F.col("event_type").isin(REPORT_EVENTS)
    downlink = F.struct(
        F.lit(DL_STAT).alias("type_id"),
        _downlink_records().alias("Records"),
        F.lit(None).cast(SUBPACKETS).alias("Subpackets"),
    )
    uplink = F.struct(
        F.when(report, UL_REPORT).otherwise(UL_BUFFER).alias("type_id"),
        F.when(report, _reports(_frame())).alias("Records"),
        F.when(~report, _subpackets(_frame())).alias("Subpackets"),
    )
    return envelope(events).select(
        "trace_id", "file_name", "msg_seq", "ts", F.inline(F.array(downlink, uplink))
    )


def dict_text() -> Column:
    """A downlink message as a line of dict-text."""

    def shown(value: Column) -> Column:
        return F.coalesce(value.cast("string"), F.lit("None"))

    def record(r: Column) -> Column:
        names = ["Frame Num", "Subframe Num", "Num RBs"]
        fields = [x for n in names for x in (F.lit(f"'{n}': "), shown(r.getField(n)), F.lit(", "))]
        return F.concat(F.lit("{"), *fields, F.lit("'Re-tx Index': None, 'ok': True}"))

    seconds = (F.unix_micros("ts") / F.lit(1e6)).cast("decimal(20,6)").cast("string")
    return F.concat(
        F.lit("{'timestamp': "), seconds, F.lit(", 'type_id': '"), "type_id", F.lit("', 'Records': ["),
        F.array_join(F.transform("Records", record), ", "), F.lit("]}"),
    ).alias("value")
