"""Every operator as a query over the benchmark tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dicttext import CORRUPT, parse_dict_text
from ..functions.radio import circular_diff, fix_report_time, frame_index
from ..functions.timefmt import epoch_seconds, span_labels, utc_instant
from ..operators import batches, fifo, filters, flush, histogram, latency, queues, records, topk
from ..operators.scan import ordered_sums
from ..operators.sequence import arrivals, departures, sequence
from ..sources.messages import (
    file_name,
    line_messages,
    message_stream,
    read_lines,
    scan_directory,
    scan_files,
)
from ..sources.sinks import write_lines
from ..staging import stage, staging_root
from ..streaming.runner import one_row, run_available
from . import tables
from .uplink import latency_from_sequence, uplink_latency

CUT_DAY = "2024-01-16"
EVENT_TYPES = ["click", "view", "error", "purchase", "signup"]
# The trace first: rows are told apart by the first bytes of it when they are sorted,
# while days begin alike.
BATCH_SCOPE = ["trace_id", "batch_id"]
TABLE_FILES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
EVENT_FILE = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string"

# Small chunks, so that the traces of small tables cross several; the benchmark
# sets the operators' own size.
CHUNK_ROWS = int(os.environ.get("CELLMETER_CHUNK_ROWS", "16"))

Query = Callable[[SparkSession, str], DataFrame]


# --- sources -----------------------------------------------------------------


def scan_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_directory(spark, sf_dir, ["events.parquet"], schema=EVENT_FILE)
    return found.select(
        F.col("user_id").cast("string").alias("trace_id"),
        file_name(),
        F.col("event_id").alias("msg_seq"),
        F.col("event_type").alias("type_id"),
        epoch_seconds(utc_instant("ts")).alias("ts"),
    )


def scan_file_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each named file, and how many have its first field."""
    counts = []
    for name in (f"{t}.parquet" for t in TABLE_FILES):
        key = tables.table(spark, sf_dir, name.removesuffix(".parquet")).schema[0]
        found = scan_files(spark, sf_dir, [name], schema=f"`{key.name}` {key.dataType.simpleString()}")
        counts.append(
            found.agg(F.count("*").alias("n_messages"), F.count(key.name).alias("n_keys")).select(
                F.lit(name).alias("file_name"), "n_messages", "n_keys"
            )
        )
    return reduce(DataFrame.unionByName, counts)


def ordered_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = tables.event_messages(spark, sf_dir).select("file_name", "msg_seq", "type_id")
    return ordered_sums(messages, ["file_name", "msg_seq"], {"position": F.lit(1)}).orderBy(
        "file_name", "msg_seq"
    )


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.event_messages(spark, sf_dir).select("file_name").distinct()


def new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _days(spark, sf_dir)
    return batches.new_files(days, days.filter(F.col("file_name") < CUT_DAY))


def visited_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _days(spark, sf_dir)
    visited = days.filter(F.col("file_name") < CUT_DAY)
    return batches.visited_union(visited, batches.new_files(days, visited))


def message_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.message_counts(tables.event_messages(spark, sf_dir), "file_name")


def batch_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = (
        tables.table(spark, sf_dir, "events")
        .groupBy(F.substring(F.col("ts").cast("string"), 1, 13).alias("batch_id"))
        .agg((F.count_if(F.col("event_type") == "error") > 0).alias("has_data"))
    )
    return batches.number_batches(hours, "batch_id", "has_data").select("batch_id", "batch_no")


# --- filters and projections ---------------------------------------------------


def type_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = tables.event_messages(spark, sf_dir).select("msg_seq", "type_id")
    return filters.subscribe(messages, ["click", "error", "click"], known=EVENT_TYPES)


def type_filter_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = tables.event_messages(spark, sf_dir).select("msg_seq", "type_id")
    return filters.subscribe_all(messages, EVENT_TYPES[:4])


def unknown_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = filters.available_types(tables.event_messages(spark, sf_dir))
    requested = spark.createDataFrame([("click",), ("refund",), ("refund",)], "type_id string")
    return filters.unknown_types(requested, known)


def malformed_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = F.when(
        F.col("msg_seq") % 7 == 0, F.substring("props", 1, 4)
    ).otherwise(F.col("props"))
    rows = (
        tables.event_messages(spark, sf_dir)
        .select("msg_seq", parse_dict_text(cut, "k int").alias("m"))
        .select("msg_seq", "m.*")
    )
    good, bad = filters.split_malformed(rows, CORRUPT)
    return good.select("msg_seq", "k", F.lit(False).alias("rejected")).unionByName(
        bad.select("msg_seq", "k", F.lit(True).alias("rejected"))
    )


def parse_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(
        F.lit("{'type_id': '"), "type_id",
        F.lit("', 'note': 'None or True', 'ok': True, 'bad': False, 'n': None, 'seq': "),
        "msg_seq", F.lit(", 'k': "), F.regexp_extract("props", r"(\d+)", 1), F.lit("}"),
    )
    schema = "type_id string, note string, ok boolean, bad boolean, n int, seq bigint, k int"
    return (
        tables.event_messages(spark, sf_dir)
        .select(parse_dict_text(line, schema).alias("m"))
        .select("m.seq", "m.type_id", "m.note", "m.ok", "m.bad", "m.n", "m.k")
    )


def epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.event_messages(spark, sf_dir).select(
        "msg_seq", epoch_seconds(F.col("ts")).alias("epoch_ts")
    )


def _rb_samples(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return records.rb_samples(tables.downlink_messages(spark, sf_dir), *keep)


def rb_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rb_samples(spark, sf_dir, "batch_id", "trace_id")


def rb_sequential(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = tables.downlink_messages(spark, sf_dir)
    return records.sequential_rb_samples(messages, "batch_id", "trace_id")


def _buffer_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = tables.nested_buffer_messages(spark, sf_dir)
    return records.buffer_samples(messages, "trace_id", "msg_seq")


def explode_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _buffer_samples(spark, sf_dir).drop("level")


def last_lcid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level of the last channel of each sample; NULL for an empty list, which still is a sample."""
    return _buffer_samples(spark, sf_dir).select(
        "msg_seq", "subpacket_pos", "sample_pos", F.col("level").alias("total_bytes")
    )


def retx_time_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = (F.col("level") - F.col("msg_seq") % 60).cast("int")
    return tables.event_messages(spark, sf_dir).select(
        "msg_seq", raw.alias("raw_time"), fix_report_time(raw).alias("report_time")
    )


def _frame_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("msg_seq")
    return tables.event_messages(spark, sf_dir).select(
        "msg_seq",
        (F.expr("msg_seq div 3") % 1024).cast("int").alias("frame"),
        (n % 10).cast("int").alias("subframe"),
        (F.col("level") * 37 % 10240).cast("int").alias("other"),
    )


def frame_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame_columns(spark, sf_dir).select(
        "msg_seq", frame_index(F.col("frame"), F.col("subframe")).alias("frame_index")
    )


def circular_diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = frame_index(F.col("frame"), F.col("subframe"))
    return _frame_columns(spark, sf_dir).select(
        "msg_seq", circular_diff(start, F.col("other")).alias("diff")
    )


def line_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.lines(tables.table(spark, sf_dir, "documents"), "text", "doc_id")


# --- utilization -----------------------------------------------------------------


def rb_total_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.utilization(_rb_samples(spark, sf_dir, "batch_id"), ["batch_id"])


def rb_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.utilization(_rb_samples(spark, sf_dir)).select("total_rbs")


def span_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rb_total_by_batch(spark, sf_dir).drop("total_rbs")


def span_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.utilization(_rb_samples(spark, sf_dir)).drop("total_rbs")


def batch_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = rb_total_by_batch(spark, sf_dir)
    labels = span_labels(F.col("min_ts"), F.col("max_ts"), F.col("total_rbs"))
    return spans.select("batch_id", *[c.alias(name) for name, c in labels.items()])


def rb_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram.auto_histogram(_rb_samples(spark, sf_dir), "num_rbs")


def rb_histogram_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = _rb_samples(spark, sf_dir, "batch_id")
    return histogram.auto_histogram(samples, "num_rbs", ["batch_id"])


def rb_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = rb_explode(spark, sf_dir)
    before = samples.filter(F.col("batch_id") < CUT_DAY)
    return before.unionByName(samples.filter(F.col("batch_id") >= CUT_DAY))


def last_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = tables.event_messages(spark, sf_dir)
    return batches.last_value(messages, ["trace_id"], "level", "msg_seq")


def topk_with_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    lines = tables.table(spark, sf_dir, "lineitem")
    return topk.top_with_other(lines, "l_suppkey", cents, k=3, exclude=[1, 2])


# --- uplink ----------------------------------------------------------------------


def _sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records.uplink_rows(tables.uplink_messages(spark, sf_dir), "trace_id")
    return sequence(rows, chunk_rows=CHUNK_ROWS)


def _staged_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(_sequence(spark, sf_dir), "sequence")


def clock_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sequence(spark, sf_dir).filter("not is_report").select("trace_id", "seq", "t")


def buffer_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = _sequence(spark, sf_dir)
    return seq.filter("delta is not null").select("trace_id", "seq", "delta")


def packet_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrivals(_sequence(spark, sf_dir)).drop("drained")


def packet_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return departures(_sequence(spark, sf_dir))


def _packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = _staged_sequence(spark, sf_dir)
    return fifo.completed_packets(seq, chunk_rows=CHUNK_ROWS)


def fifo_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packets(spark, sf_dir).select("trace_id", "seq", "size", "done_seq", "t_done")


def fifo_first_byte(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = _staged_sequence(spark, sf_dir)
    matched = fifo.match_drains(seq, chunk_rows=CHUNK_ROWS)
    return matched.filter("first is not null").select(
        "trace_id",
        "seq",
        F.col("first.seq").alias("first_seq"),
        F.col("first.t").alias("t_first"),
    )


def fifo_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packets(spark, sf_dir).select("trace_id", "seq", "waiting", "tx")


def _flushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = _staged_sequence(spark, sf_dir)
    packets = fifo.completed_packets(seq, chunk_rows=CHUNK_ROWS)
    slots = stage(fifo.last_per_drain(packets), "slots")
    reports = seq.filter("is_report")
    return flush.find_flush(slots, reports, chunk_rows=CHUNK_ROWS)


def latency_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flushed(spark, sf_dir).select("trace_id", "slot", "seq", "flush")


def slot_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flush.released_groups(_flushed(spark, sf_dir))


def retx_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = _staged_sequence(spark, sf_dir)
    return latency_from_sequence(seq, chunk_rows=CHUNK_ROWS).select("trace_id", "slot", "flush", "retx")


def uplink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uplink_latency(tables.uplink_messages(spark, sf_dir), chunk_rows=CHUNK_ROWS)


def latency_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latency.latency_sums(uplink(spark, sf_dir))


def tx_block_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = tables.uplink_from(tables.event_messages(spark, sf_dir))
    reports = records.report_records(messages)
    return latency.block_counts(reports)


def latency_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State starts anew in each batch, as it does for a stream's batches."""
    packets = uplink_latency(tables.uplink_messages(spark, sf_dir), BATCH_SCOPE, CHUNK_ROWS)
    days = _days(spark, sf_dir).withColumnRenamed("file_name", "batch_id")
    return latency.latency_by_batch(packets, batches.number_batches(days, "batch_id"))


def latency_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latency.latency_running(latency_by_batch(spark, sf_dir))


def latency_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latency.latency_sums(latency_by_batch(spark, sf_dir))


def latency_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latency.latency_stack(latency_by_batch(spark, sf_dir))


def queue_match_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "view", 2)
    entries = (
        tables.event_messages(spark, sf_dir)
        .select("trace_id", F.col("msg_seq").alias("seq"), side.alias("side"))
        .filter(F.col("side").isNotNull())
    )
    return queues.unmatched(entries, ["trace_id"])


# --- streaming -------------------------------------------------------------------


def stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events file as a stream, through to the totals of the run."""
    base = f"{staging_root(spark)}/stream-{uuid.uuid4().hex}"
    schema = tables.table(spark, sf_dir, "events").schema
    events = message_stream(spark, sf_dir, ["events.parquet"], schema=schema)
    run_available(events, f"{base}/out", f"{base}/state", prepare=tables.radio_messages)
    spans = spark.read.parquet(f"{base}/out/utilization_total")
    sums = spark.read.parquet(f"{base}/out/latency_total")
    return one_row(spans.select("total_rbs", "min_ts", "max_ts", "minutes"), sums)


def _replayed(spark: SparkSession, sf_dir: str, **settings) -> str:
    """Messages of the month as a stream, a few days at a time; where the results are.

    Each part's files are written after the run before has ended, so every batch
    but the first is a restart from the checkpoint. The parts are as in
    ``tables.PART_DAYS``.
    """
    base = f"{staging_root(spark)}/replay-{uuid.uuid4().hex}"
    # A part's events are picked and dealt anew before messages are made of them: in a
    # table in order of time few tasks would have them all.
    events = tables.table(spark, sf_dir, "events")
    messages = tables.radio_messages(events.repartition("event_id", "ts"))
    part = tables.part_of("file_name")
    days = tables.envelope(events).select(part.alias("part"))
    for number in sorted(row.part for row in days.distinct().collect()):
        messages.filter(part == number).write.mode("append").parquet(f"{base}/in")
        stream = message_stream(spark, f"{base}/in", [".parquet"])
        run_available(stream, f"{base}/out", f"{base}/state", totals=False, **settings)
    return f"{base}/out"


def stream_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of each batch of a stream whose uplink state starts anew in each."""
    out = _replayed(spark, sf_dir, chunk_rows=CHUNK_ROWS)
    batch = F.col("batch_id").cast("bigint").alias("batch_id")
    return spark.read.parquet(f"{out}/batches").select(
        batch, "n_messages", "n_samples", "total_rbs", "min_ts", "max_ts", *latency.PARTS
    )


def stream_trace_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets of a stream whose traces go on from batch to batch: those of one run."""
    out = _replayed(spark, sf_dir, scope="trace", chunk_rows=CHUNK_ROWS, compact_every=3)
    return spark.read.parquet(f"{out}/uplink_latency").select(
        "trace_id", "slot", "waiting", "tx", "retx"
    )


# --- text ------------------------------------------------------------------------


def dict_text_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as lines of dict-text, written to files and read back in line order.

    Per downlink message its number of records and blocks, and the message
    before it in its file.
    """
    path = f"{staging_root(spark)}/text-{uuid.uuid4().hex}"
    messages = tables.downlink_messages(spark, sf_dir)
    days = messages.repartition("file_name").sortWithinPartitions("file_name", "msg_seq")
    lines = days.select(F.col("file_name").alias("day"), tables.dict_text())
    lines.write.partitionBy("day").text(path)
    found = line_messages(read_lines(spark, f"{path}/*", name=F.col("_metadata.file_path")))
    before = F.lag("ts").over(Window.partitionBy("file_name").orderBy("msg_seq"))
    return found.select(
        "type_id",
        epoch_seconds(F.col("ts")).alias("ts"),
        epoch_seconds(before).alias("ts_before"),
        F.size("Records").cast("bigint").alias("n_records"),
        F.aggregate(
            F.col("Records").getField("Num RBs"), F.lit(0).cast("bigint"),
            lambda total, blocks: total + F.coalesce(blocks, F.lit(0)),
        ).alias("total_rbs"),
    )


def line_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uplink messages written as lines of JSON and read back, through to their rows."""
    path = f"{staging_root(spark)}/lines-{uuid.uuid4().hex}"
    messages = tables.uplink_messages(spark, sf_dir)
    write_lines(messages.drop("batch_id"), path)
    read = line_messages(read_lines(spark, path))
    rows = records.uplink_rows(read, "trace_id")
    return rows.groupBy("trace_id").agg(
        F.count_if("is_report").alias("n_reports"),
        F.count_if(~F.col("is_report")).alias("n_samples"),
        F.count_if("first_tx").alias("n_first"),
        F.sum("report_time").alias("report_times"),
        F.sum("level").alias("levels"),
        F.sum(F.col("sub_fn") + 16 * F.col("sys_fn")).alias("frames"),
    )


QUERIES: dict[str, Query] = {
    "scan_messages": scan_messages,
    "scan_file_set": scan_file_set,
    "ordered_messages": ordered_messages,
    "new_files": new_files,
    "visited_union": visited_union,
    "message_count": message_count,
    "batch_numbering": batch_numbering,
    "type_filter": type_filter,
    "type_filter_all": type_filter_all,
    "unknown_types": unknown_types,
    "malformed_split": malformed_split,
    "parse_props": parse_props,
    "epoch_seconds": epoch,
    "rb_explode": rb_explode,
    "rb_sequential": rb_sequential,
    "explode_samples": explode_samples,
    "last_lcid": last_lcid,
    "retx_time_fix": retx_time_fix,
    "frame_index": frame_indexes,
    "circular_diff": circular_diffs,
    "line_split": line_split,
    "rb_total_by_batch": rb_total_by_batch,
    "rb_total": rb_total,
    "span_by_batch": span_by_batch,
    "span_total": span_total,
    "batch_label": batch_label,
    "rb_histogram": rb_histogram,
    "rb_histogram_by_batch": rb_histogram_by_batch,
    "rb_append": rb_append,
    "last_value": last_value,
    "topk_with_other": topk_with_other,
    "clock_fill": clock_fill,
    "buffer_delta": buffer_delta,
    "packet_arrivals": packet_arrivals,
    "packet_departures": packet_departures,
    "fifo_completion": fifo_completion,
    "fifo_first_byte": fifo_first_byte,
    "fifo_latency": fifo_latency,
    "latency_flush": latency_flush,
    "slot_last_wins": slot_last_wins,
    "retx_tag": retx_tag,
    "uplink_latency": uplink,
    "latency_sums": latency_sums,
    "tx_block_counts": tx_block_counts,
    "latency_by_batch": latency_by_batch,
    "latency_running": latency_running,
    "latency_total": latency_total,
    "latency_stack": latency_stack,
    "queue_match_unmatched": queue_match_unmatched,
    "stream_totals": stream_totals,
    "stream_by_batch": stream_by_batch,
    "stream_trace_scope": stream_trace_scope,
    "dict_text_messages": dict_text_messages,
    "line_round_trip": line_round_trip,
}
