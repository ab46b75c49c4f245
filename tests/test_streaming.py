"""A stream of files gives what the batch functions give on the same files."""

from __future__ import annotations

import datetime as dt
import re
from pathlib import Path

from pyspark.sql import functions as F

from cellmeter.operators.batches import utilization
from cellmeter.operators.records import rb_samples
from cellmeter.plans.uplink import uplink_latency
from cellmeter.schemas import DL_STAT, MESSAGES, UL_BUFFER, UL_REPORT
from cellmeter.sources.messages import line_messages, line_stream, message_stream
from cellmeter.staging import staging_root
from cellmeter.streaming.runner import (
    clear_output,
    process_batch,
    run_available,
    start_live,
    stop_live,
    write_totals,
)
from cellmeter.streaming.state import STATE_SCHEMAS, TraceState

TS = dt.datetime(2024, 1, 1, 0, 0, 0)


def file_rows(number):
    """Two packets, one repeat, and a downlink message unless the number is 2."""
    name = f"f{number}.json"
    base = 100 * number
    rows = []

    def add(type_id, recs=None, subs=None):
        ts = TS + dt.timedelta(seconds=60 * number + len(rows))
        rows.append(("t", name, len(rows), type_id, ts, recs, subs))

    levels = [0, 50, 20, 0, 10, 0] if number != 3 else [0, 50, 20]
    for i, level in enumerate(levels):
        t = base + i
        add(UL_BUFFER, subs=[([(t % 10, t // 10, [(level, None, None, None)])],)])
    add(UL_REPORT, recs=[(None, None, None, base + 3, "Second")])
    add(UL_REPORT, recs=[(None, None, None, base + 9, "First")])
    if number != 2:
        add(DL_STAT, recs=[(1, 2, 10 * number, None, None), (1, 3, None, None, None)])
    return rows


def test_stream_equals_batch(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    files = {n: spark.createDataFrame(file_rows(n), MESSAGES) for n in (1, 2, 3)}
    read = lambda: message_stream(spark, inbox, [".json"], "json", max_files=1)

    for n in files:
        files[n].coalesce(1).write.mode("append").json(inbox)
        run_available(read(), out, state)

    def rows(name, columns):
        return sorted(map(tuple, spark.read.parquet(f"{out}/{name}").select(*columns).collect()))

    for n, messages in files.items():
        batch = n - 1
        want = sorted(map(tuple, uplink_latency(messages).collect()))
        got = spark.read.parquet(f"{out}/uplink_latency").filter(F.col("batch_id") == batch)
        columns = ["trace_id", "slot", "waiting", "tx", "retx"]
        assert sorted(map(tuple, got.select(*columns).collect())) == want
        assert len(want) == (0 if n == 3 else 2)

    everything = files[1].union(files[2]).union(files[3])
    want = utilization(rb_samples(everything.filter(F.col("type_id") == DL_STAT))).first()
    got = spark.read.parquet(f"{out}/utilization_total").first()
    assert (got.total_rbs, got.min_ts, got.max_ts) == (want.total_rbs, want.min_ts, want.max_ts)
    assert got.total_rbs == 40

    before = rows("latency_by_batch", ["batch_no", "waiting", "tx", "retx"])
    assert len(before) == 3 and before[2] == (3, 0, 0, 0)
    assert before[0][3] == 8 and before[0][1:] == before[1][1:]
    total = rows("latency_total", ["waiting", "tx", "retx"])
    assert total == [tuple(sum(b[i] for b in before) for i in (1, 2, 3))]

    # Nothing new: a restart from the checkpoint adds nothing.
    run_available(read(), out, state)
    assert rows("latency_by_batch", ["batch_no", "waiting", "tx", "retx"]) == before

    write_totals(spark, out, require_dl=True)
    assert [r[1] for r in rows("latency_by_batch", ["batch_no", "batch_id"])] == [0, 2]

    clear_output(spark, out)
    assert not (tmp_path / "out").exists()


def test_trace_scope_keeps_packets_open_over_batches(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    everything = [r for n in (1, 3, 4) for r in file_rows(n)]
    staged = Path(staging_root(spark))
    before = set(staged.iterdir()) if staged.exists() else set()
    # The packet that is left in the queue of file 3 drains in file 4.
    for n in (1, 3, 4):
        spark.createDataFrame(file_rows(n), MESSAGES).coalesce(1).write.mode("append").json(inbox)
        stream = message_stream(spark, inbox, [".json"], "json", max_files=1)
        run_available(stream, out, state, scope="trace")

    columns = ["trace_id", "slot", "waiting", "tx", "retx"]
    assert set(staged.iterdir()) == before  # every batch removed its staged tables
    got = spark.read.parquet(f"{out}/uplink_latency").select(*columns).collect()
    want = uplink_latency(spark.createDataFrame(everything, MESSAGES)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) == 5
    kept = {p.name for p in (tmp_path / "out" / "_state" / "traces").iterdir()}
    assert kept == {"run=delta-0", "run=delta-1", "run=delta-2"}


def test_live_run_writes_totals_when_it_stops(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    query = start_live(message_stream(spark, inbox, [".json"], "json"), out, state)
    spark.createDataFrame(file_rows(1), MESSAGES).coalesce(1).write.mode("append").json(inbox)
    stop_live(query, spark, out)
    assert spark.read.parquet(f"{out}/latency_total").first().retx == 8


def test_empty_inbox_has_no_totals(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = message_stream(spark, str(tmp_path / "in"), [".json"], "json")
    run_available(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    assert not (tmp_path / "out" / "latency_total").exists()


def test_a_batch_is_read_once(spark, tmp_path):
    """Every row of a batch passes a counter between the source and the job once."""
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = file_rows(1) + file_rows(3)
    spark.createDataFrame(rows, MESSAGES).coalesce(1).write.json(inbox)
    passed = spark.sparkContext.accumulator(0)

    def counted(batch):
        def count(parts):
            for part in parts:
                passed.add(part.num_rows)
                yield part

        return batch.mapInArrow(count, batch.schema)

    stream = message_stream(spark, inbox, [".json"], "json")
    run_available(stream, out, state, prepare=counted)
    assert passed.value == len(rows)
    summary = spark.read.parquet(f"{out}/batches").first()
    assert (summary.n_messages, summary.n_samples, summary.total_rbs) == (2, 2, 40)


def test_totals_read_no_samples(spark, tmp_path):
    out = str(tmp_path / "out")
    for n in (1, 2, 3):
        process_batch(spark.createDataFrame(file_rows(n), MESSAGES), n, out)
    write_totals(spark, out)
    tables = ["utilization_total", "rb_histogram_total", "latency_total", "latency_running"]
    want = {t: sorted(map(tuple, spark.read.parquet(f"{out}/{t}").collect())) for t in tables}
    clear_output(spark, f"{out}/rb_samples")
    clear_output(spark, f"{out}/uplink_latency")
    write_totals(spark, out)
    got = {t: sorted(map(tuple, spark.read.parquet(f"{out}/{t}").collect())) for t in tables}
    assert got == want and want["utilization_total"][0][0] == 40


def state_tables(spark, traces, level):
    """One packet, slot and repeat per trace."""
    rows = spark.createDataFrame([(t,) for t in traces], "trace_id string")
    values = {
        "packets": "1L as seq, 2 as t, 3L as delta, 4L as arrived, 5L as drained, cast(null as struct<seq:bigint,t:int>) as first",
        "slots": f"{level} as slot, 1L as seq, 2 as waiting, 3 as tx",
        "repeats": "1 as slot, 1L as seq",
        "traces": f"1 as t, {level}L as level, 0L as arrived, 0L as drained, 9L as seq",
    }
    return {name: rows.selectExpr("trace_id", *re.split(r", (?![^(<]*[)>])", v)) for name, v in values.items()}


def test_state_of_one_of_many_traces_costs_one(spark, tmp_path):
    log = TraceState(spark, str(tmp_path / "s"))
    many = [f"t{i}" for i in range(10_000)]
    log.write(0, state_tables(spark, many, 1))
    one = spark.createDataFrame([("t77",)], "trace_id string")
    before = log.read(1, one)
    assert {name: table.count() for name, table in before.items()} == dict.fromkeys(STATE_SCHEMAS, 1)
    after = state_tables(spark, ["t77"], 2)
    after["packets"] = after["packets"].limit(0)
    log.write(1, after)
    for name in STATE_SCHEMAS:
        written = spark.read.schema("trace_id string").parquet(f"{tmp_path}/s/{name}/run=delta-1")
        assert written.count() == (0 if name == "packets" else 1)
    # The trace's packet is gone with its newest entry, the others keep theirs.
    two = spark.createDataFrame([("t77",), ("t78",), ("new",)], "trace_id string")
    found = log.read(2, two)
    assert [r.trace_id for r in found["packets"].collect()] == ["t78"]
    assert sorted((r.trace_id, r.level) for r in found["traces"].collect()) == [("t77", 2), ("t78", 1)]
    assert sorted((r.trace_id, r.slot) for r in found["slots"].collect()) == [("t77", 2), ("t78", 1)]
    # A batch that runs again reads what it read before.
    assert log.read(1, one)["traces"].first().level == 1


def test_state_log_becomes_one_base(spark, tmp_path):
    log = TraceState(spark, str(tmp_path / "s"), compact_every=2)
    names = lambda: sorted(p.name for p in (tmp_path / "s" / "traces").iterdir())
    touched = spark.createDataFrame([(t,) for t in "abc"], "trace_id string")
    for batch, traces in enumerate(["abc", "b", "a", "c", "b"]):
        log.compact(batch)
        if log.read(batch, touched):
            log.read(batch, touched)["traces"].count()
        log.write(batch, state_tables(spark, traces, 10 + batch))
    assert names() == ["run=base-3", "run=delta-4"]
    found = {r.trace_id: r.level for r in log.read(5, touched)["traces"].collect()}
    assert found == {"a": 12, "b": 14, "c": 13}
    found = {r.trace_id: r.level for r in log.read(4, touched)["traces"].collect()}
    assert found == {"a": 12, "b": 11, "c": 13}


def test_dict_text_files_as_a_stream(spark, tmp_path):
    """Lines of text files, numbered in the stream, through to the results."""
    inbox = tmp_path / "in"
    inbox.mkdir()
    line = "{'timestamp': %d.5, 'type_id': '%s', 'Records': [{'Num RBs': %d, 'ok': True}, {'Num RBs': None}]}"
    for n in (1, 2):
        text = "\n".join(line % (100 * n + i, DL_STAT, i) for i in range(50))
        (inbox / f"log{n}.txt").write_text(text + "\n\nnot a message\n")
        stream = line_stream(spark, str(inbox))
        run_available(stream, str(tmp_path / "out"), str(tmp_path / "state"), prepare=line_messages)
    got = spark.read.parquet(str(tmp_path / "out" / "batches")).orderBy("batch_id").collect()
    assert [(r.n_messages, r.n_samples, r.total_rbs, r.min_ts) for r in got] == [
        (50, 50, 1225, 100), (50, 50, 1225, 200)
    ]
