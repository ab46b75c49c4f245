"""Micro-batch runs over a directory of message files.

Each micro-batch goes through the batch operators and replaces its own folder
of every result table, so a batch that is run again after a failure leaves the
same result. Run totals are aggregations over those tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.timefmt import minutes_between, span_labels
from ..operators.batches import number_batches
from ..operators.histogram import auto_histogram, value_counts
from ..operators.latency import PARTS, latency_running, latency_stack, latency_sums
from ..operators.records import rb_samples, uplink_rows
from ..operators.scan import CHUNK_ROWS
from ..plans.uplink import uplink_carried, uplink_latency
from ..schemas import CUSTOM, REQUIRED_TYPES
from ..sources.sinks import write_batch, write_table
from ..staging import delete_path, path_exists, stage, temporary_stages
from .state import COMPACT_EVERY, TraceState

STATE_DIR = "_state"

Prepare = Callable[[DataFrame], DataFrame]

# A batch's summary, and those of its columns that are 0 where there is nothing.
_SUMMARY = ["n_messages", "n_samples", "total_rbs", "min_ts", "max_ts", *PARTS]
_COUNTS = ["n_messages", "n_samples", *PARTS]

# What the analyses need of a message.
_COLUMNS = ["trace_id", "file_name", "msg_seq", "type_id", "ts", "Records", "Subpackets"]


def _carried_packets(
    uplink: DataFrame, batch_id: int, out: str, chunk_rows: int, compact_every: int
) -> DataFrame:
    """Packets of a batch that goes on from the state that earlier batches left."""
    log = TraceState(uplink.sparkSession, f"{out}/{STATE_DIR}", compact_every=compact_every)
    log.compact(batch_id)
    touched = stage(uplink.select("trace_id").distinct(), "touched")
    state = log.read(batch_id, touched)
    packets, after = uplink_carried(uplink_rows(uplink, "trace_id"), state, chunk_rows=chunk_rows)
    log.write(batch_id, after)
    return packets


def _typed(messages: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """The messages that either analysis reads, stored by analysis in one pass, and counts.

    Custom packets go with the downlink, as a subscription to it has them.
    """
    kind = (
        F.when(F.col("type_id").isin([*REQUIRED_TYPES["utilization"], CUSTOM]), "dl")
        .when(F.col("type_id").isin(REQUIRED_TYPES["uplink_latency"]), "ul")
        .alias("kind")
    )
    seen = Observation()
    typed = messages.select(*_COLUMNS, kind).observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.col("kind") == "dl").alias("dl"))
    stored = stage(typed.filter(F.col("kind").isNotNull()), "typed", partition_by=["kind"])
    return stored, seen.get


def process_batch(
    messages: DataFrame,
    batch_id: int,
    out: str,
    scope: str = "batch",
    chunk_rows: int = CHUNK_ROWS,
    compact_every: int = COMPACT_EVERY,
) -> None:
    """Write one batch's samples, value counts, histogram, packets and summary.

    With scope ``batch`` uplink state starts anew in each batch and spans its
    files; with scope ``trace`` a batch goes on where the one before ended.
    The batch is read once, and its counts and sums are taken as tables are written.
    """
    spark = messages.sparkSession
    typed, seen = _typed(messages)
    if not seen.get("n"):
        return

    def written(name: str) -> DataFrame:
        return spark.read.parquet(f"{out}/{name}/batch_id={batch_id}")

    spans = Observation()
    samples = rb_samples(typed.filter("kind = 'dl'"), "trace_id").observe(
        spans,
        F.count(F.lit(1)).alias("n_samples"),
        F.sum("num_rbs").alias("total_rbs"),
        F.floor(F.min("ts")).alias("min_ts"),
        F.floor(F.max("ts")).alias("max_ts"),
    )
    write_batch(samples, out, "rb_samples", batch_id)
    write_batch(value_counts(written("rb_samples"), "num_rbs"), out, "rb_values", batch_id)
    histogram = auto_histogram(written("rb_values"), "num_rbs", weight="n")
    write_batch(histogram, out, "rb_histogram_by_batch", batch_id)

    uplink = typed.filter("kind = 'ul'")
    if scope == "trace":
        packets = _carried_packets(uplink, batch_id, out, chunk_rows, compact_every)
    else:
        packets = uplink_latency(uplink, chunk_rows=chunk_rows)
    sums = Observation()
    packets = packets.observe(sums, *[F.coalesce(F.sum(p), F.lit(0)).alias(p) for p in PARTS])
    write_batch(packets, out, "uplink_latency", batch_id)

    # A one-row summary: sums are 0 and spans NULL where a batch has no rows.
    found = {"n_messages": seen["dl"], **spans.get, **sums.get}
    row = [found.get(name, 0 if name in _COUNTS else None) for name in _SUMMARY]
    schema = ", ".join(f"{name} bigint" for name in _SUMMARY)
    write_batch(spark.createDataFrame([row], schema), out, "batches", batch_id)


def one_row(*rows: DataFrame) -> DataFrame:
    """One-row tables side by side."""
    under = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return under.agg(*[F.max(c).alias(c) for c in under.columns])


def _writer(
    stream: DataFrame, out: str, checkpoint: str, prepare: Prepare | None, **settings
):
    def handle(batch: DataFrame, batch_id: int) -> None:
        with temporary_stages(batch.sparkSession):
            process_batch(prepare(batch) if prepare else batch, batch_id, out, **settings)

    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)


def start_live(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    prepare: Prepare | None = None,
    interval: str = "1 second",
    **settings,
) -> StreamingQuery:
    """Poll for new files until the caller stops the returned query.

    ``settings`` go to ``process_batch``.
    """
    writer = _writer(stream, out, checkpoint, prepare, **settings)
    return writer.trigger(processingTime=interval).start()


def stop_live(
    query: StreamingQuery, spark: SparkSession, out: str, require_dl: bool = False
) -> None:
    """End a live run after the files it has seen, then write the totals."""
    query.processAllAvailable()
    query.stop()
    write_totals(spark, out, require_dl)


def run_available(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    prepare: Prepare | None = None,
    require_dl: bool = False,
    totals: bool = True,
    **settings,
) -> None:
    """Process every file not used yet, then write the totals, if they are wanted."""
    writer = _writer(stream, out, checkpoint, prepare, **settings)
    writer.trigger(availableNow=True).start().awaitTermination()
    if totals:
        write_totals(stream.sparkSession, out, require_dl)


def write_totals(spark: SparkSession, out: str, require_dl: bool = False) -> None:
    """Whole-run tables from what each batch has added up; no samples are read again.

    ``require_dl`` leaves out the latency of batches without downlink samples. A
    run that has had no message has no totals.
    """
    if path_exists(spark, f"{out}/batches"):
        with temporary_stages(spark):
            _write_totals(spark, out, require_dl)


def _write_totals(spark: SparkSession, out: str, require_dl: bool) -> None:
    batches = spark.read.parquet(f"{out}/batches")
    spans = batches.agg(
        F.sum("n_samples").alias("n_samples"),
        F.sum("total_rbs").alias("total_rbs"),
        F.min("min_ts").alias("min_ts"),
        F.max("max_ts").alias("max_ts"),
    ).filter(F.col("n_samples") > 0)
    minutes = minutes_between(F.col("min_ts"), F.col("max_ts")).alias("minutes")
    spans = spans.select("total_rbs", "min_ts", "max_ts", minutes)
    labels = span_labels(F.col("min_ts"), F.col("max_ts"), F.col("total_rbs"))
    write_table(
        spans.select("*", *[c.alias(name) for name, c in labels.items()]),
        out, "utilization_total",
    )
    values = spark.read.parquet(f"{out}/rb_values")
    write_table(auto_histogram(values, "num_rbs", weight="n"), out, "rb_histogram_total")

    batches = batches.withColumn(
        "has_data", (F.col("n_samples") > 0) if require_dl else F.lit(True)
    )
    write_table(
        number_batches(batches, "batch_id", "has_data").select("batch_no", "batch_id", *PARTS),
        out, "latency_by_batch",
    )
    by_batch = spark.read.parquet(f"{out}/latency_by_batch")
    write_table(latency_running(by_batch), out, "latency_running")
    write_table(latency_stack(by_batch), out, "latency_stack")
    write_table(latency_sums(by_batch), out, "latency_total")


def clear_output(spark: SparkSession, out: str) -> None:
    """Empty the output folder before a new run."""
    delete_path(spark, out)
