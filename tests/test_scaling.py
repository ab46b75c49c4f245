"""Work that is done once, not once per reader of its result."""

from __future__ import annotations

import datetime as dt

import numpy as np

from cellmeter.operators.nextabove import first_above
from cellmeter.operators.records import uplink_rows
from cellmeter.operators.sequence import sequence
from cellmeter.plans import queries
from cellmeter.schemas import MESSAGES, UL_BUFFER, UL_REPORT
from cellmeter.streaming.state import TraceState

CHANNEL = [(5, None, None, None)]


def test_rows_of_a_sequence_are_made_once(spark):
    messages = [
        ("t", "f", n, UL_BUFFER, None, None, [([(n % 10, n // 10, [(n % 7, None, None, None)])],)])
        for n in range(40)
    ]
    rows = uplink_rows(spark.createDataFrame(messages, MESSAGES), "trace_id").coalesce(1)
    passed = spark.sparkContext.accumulator(0)

    def count(parts):
        for part in parts:
            passed.add(part.num_rows)
            yield part

    found = sequence(rows.mapInArrow(count, rows.schema), chunk_rows=8)
    assert sorted(r.seq for r in found.select("seq").collect()) == list(range(1, 41))
    assert passed.value == 40


def test_rows_of_odd_messages_need_no_functions_over_nested_arrays(spark):
    first = [(None, None, None, 5, "First")]
    nested = [(None,), ([(1, 2, CHANNEL), None, (3, 4, []), (4, 5, [(7, None, None, None), None])],)]
    messages = [
        ("t", "f", 1, UL_BUFFER, None, first, nested),
        ("t", "f", 2, UL_REPORT, None, [(None, None, None, -3, "First"), None], nested),
        ("t", "f", 3, UL_BUFFER, None, first, None),
        ("t", "f", 4, UL_REPORT, None, None, nested),
        ("t", "f", 5, None, None, first, nested),
    ]
    rows = uplink_rows(spark.createDataFrame(messages, MESSAGES))
    columns = ["msg_seq", "pos", "is_report", "sub_fn", "sys_fn", "level", "report_time", "first_tx"]
    assert sorted(map(tuple, rows.select(*columns).collect())) == [
        (1, 0, False, 1, 2, 5, None, None),
        (1, 1, False, None, None, None, None, None),
        (1, 2, False, 3, 4, None, None, None),
        (1, 3, False, 4, 5, None, None, None),
        (2, 0, True, None, None, None, 1021, True),
        (2, 1, True, None, None, None, None, False),
    ]
    assert "transform(" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_a_search_of_short_chunks_makes_no_long_runs(monkeypatch):
    rng = np.random.default_rng(3)
    values = rng.integers(0, 50, 4096)
    values[7::8] = 99  # the end of each chunk of 8
    start = rng.integers(0, 4000, 500)
    limit = rng.integers(0, 60, 500)
    want = [s + int(np.argmax(values[s:] > m)) for s, m in zip(start, limit)]
    made = []
    maximum = np.maximum
    monkeypatch.setattr(np, "maximum", lambda *a: made.append(1) or maximum(*a))
    assert first_above(values, start, limit, 8).tolist() == want
    assert len(made) == 3
    assert first_above(values, start, limit).tolist() == want


def test_newest_state_is_found_once(spark, tmp_path):
    log = TraceState(spark, str(tmp_path / "s"))
    values = {
        "packets": "1L as seq, 2 as t, 3L as delta, 4L as arrived, 5L as drained, "
        "cast(null as struct<seq:bigint,t:int>) as first",
        "slots": "1 as slot, 1L as seq, 2 as waiting, 3 as tx",
        "repeats": "1 as slot, 1L as seq",
        "traces": "1 as t, 2L as level, 0L as arrived, 0L as drained, 9L as seq",
    }
    for batch in (0, 1):
        log.write(
            batch, {n: spark.sql(f"select 'a' as trace_id, {v}") for n, v in values.items()}
        )
    state = log.read(2, spark.sql("select 'a' as trace_id"))
    for name, table in state.items():
        assert table.count() == 1
        assert "Aggregate" not in table._jdf.queryExecution().optimizedPlan().toString(), name


def test_messages_of_a_replay_are_made_part_by_part(spark, tmp_path, monkeypatch):
    """The messages of the whole table are not stored before the first part is read."""
    days = [dt.datetime(2024, 1, day, 12) for day in (1, 6, 7, 20, 30)]
    rows = [(n, day, n % 2, "click", 5.5, None) for n, day in enumerate(days)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(queries, "stage", None)
    monkeypatch.setattr(queries, "message_stream", lambda *args: None)
    seen = []

    def run(stream, out, state, **settings):
        files = spark.read.parquet(out.removesuffix("/out") + "/in")
        seen.append(sorted(r.msg_seq for r in files.select("msg_seq").distinct().collect()))

    monkeypatch.setattr(queries, "run_available", run)
    queries._replayed(spark, str(tmp_path))
    assert seen == [[0, 1], [0, 1, 2], [0, 1, 2, 3], [0, 1, 2, 3, 4]]
