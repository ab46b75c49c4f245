"""Uplink operators against the rules as definitions, with chunks of a few rows."""

from __future__ import annotations

import random

import numpy as np
import pytest

from cellmeter.operators.fifo import completed_packets, last_per_drain
from cellmeter.operators.flush import find_flush
from cellmeter.operators.nextabove import first_above
from cellmeter.operators.records import uplink_rows
from cellmeter.operators.sequence import sequence
from cellmeter.plans.uplink import latency_from_sequence, uplink_carried, uplink_latency
from cellmeter.staging import stage
from cellmeter.schemas import MESSAGES, UL_BUFFER, UL_REPORT

from model import replay

ROW_SCHEMA = (
    "trace_id string, file_name string, msg_seq bigint, pos int, is_report boolean, "
    "sub_fn int, sys_fn int, level bigint, report_time int, first_tx boolean"
)


def rows_of(name, steps, file_rows=1000):
    out = []
    for i, step in enumerate(steps):
        place = (name, f"f{i // file_rows:05d}", i % file_rows, 0)
        if step[0] == "s":
            out.append((*place, False, step[1], step[2], step[3], None, None))
        else:
            time = step[1] + 1024 if step[1] < 0 else step[1]
            out.append((*place, True, None, None, None, time, step[2]))
    return out


def random_steps(rng):
    """A trace that meets wraps, exact drains, orphans, idle and missing levels."""
    n = rng.randrange(1, 60)
    top = rng.choice([2, 6, 400])
    base = rng.choice([0, 95, 1018])
    steps, clock = [], -11
    for _ in range(n):
        if rng.random() < 0.55:
            level = None if rng.random() < 0.1 else rng.choice([0, rng.randrange(top + 1)])
            sub = rng.randrange(16)
            sys_fn = (base + rng.randrange(8)) % 1024
            steps.append(("s", sub, sys_fn, level))
            clock = sys_fn * 10 + sub if sub < 10 else (clock if clock == -11 else (clock + 1) % 10240)
        else:
            near = clock + rng.randrange(-3, 12)
            time = near if rng.random() < 0.7 else rng.choice([rng.randrange(-20, 10240), 3, 19, 20, 1000, 1001])
            steps.append(("r", min(time, 10239), rng.random() < 0.5))
    return steps


@pytest.fixture(scope="module")
def traces():
    rng = random.Random(11)
    return {f"t{i:03d}": random_steps(rng) for i in range(250)}


@pytest.fixture(scope="module")
def expected(traces):
    return {name: replay(steps) for name, steps in traces.items()}


def frame(spark, traces, file_rows):
    rows = [r for name, steps in traces.items() for r in rows_of(name, steps, file_rows)]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, ROW_SCHEMA)


@pytest.mark.parametrize("file_rows,chunk_rows", [(1000, 1 << 18), (9, 4), (1000, 1)])
def test_random_traces(spark, traces, expected, file_rows, chunk_rows):
    rows = frame(spark, traces, file_rows)
    seq = stage(sequence(rows, chunk_rows=chunk_rows), "test")
    got = sorted(
        (r.trace_id, r.seq, r.t, r.delta, r.arrived, r.drained) for r in seq.collect()
    )
    want = sorted(
        (name, i + 1, *row) for name, tr in expected.items() for i, row in enumerate(tr.rows)
    )
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert got == want

    packets = completed_packets(seq, chunk_rows=chunk_rows)
    got = sorted(
        (r.trace_id, r.seq, r.size, r.t_in, r.t_first, r.t_done, r.done_seq)
        for r in packets.collect()
    )
    want = sorted((name, *c) for name, tr in expected.items() for c in tr.completed)
    assert got == want

    result = latency_from_sequence(seq, chunk_rows=chunk_rows)
    got = sorted((r.trace_id, r.slot, r.waiting, r.tx, r.retx) for r in result.collect())
    want = sorted((name, *p) for name, tr in expected.items() for p in tr.released)
    assert got == want
    assert len(want) > 300 and sum(p[4] for p in want) > 0


@pytest.mark.parametrize("chunk_rows", [1 << 18, 5])
def test_carried_state_gives_what_one_run_gives(spark, traces, expected, chunk_rows):
    rows = stage(frame(spark, traces, 9), "rows")
    files = sorted(r.file_name for r in rows.select("file_name").distinct().collect())
    state, got = None, []
    for part in (files[:1], files[1:4], files[4:]):
        result, after = uplink_carried(
            rows.filter(rows.file_name.isin(part)), state, chunk_rows=chunk_rows
        )
        got += [tuple(r) for r in result.collect()]
        state = {name: stage(table, f"state-{name}") for name, table in after.items()}
    want = [(name, *p) for name, tr in expected.items() for p in tr.released]
    assert sorted(got) == sorted(want)
    packets = sum((row[1] or 0) > 0 for tr in expected.values() for row in tr.rows)
    still_queued = packets - sum(len(tr.completed) for tr in expected.values())
    assert state["packets"].count() == still_queued


def run(spark, traces, **kw):
    rows = [r for name, steps in traces.items() for r in rows_of(name, steps)]
    return stage(sequence(spark.createDataFrame(rows, ROW_SCHEMA), **kw), "test")


def levels_at(start, levels):
    """Samples with valid readings at consecutive subframes."""
    return [("s", (start + i) % 10, (start + i) // 10, v) for i, v in enumerate(levels)]


def test_clock_and_delta_golden(spark):
    readings = [(15, 0), (3, 5), (15, 0), (15, 0), (9, 1023), (12, 0)]
    traces = {
        "clock": [("s", a, b, None) for a, b in readings],
        "delta": levels_at(0, [0, 100, 100, 60]),
    }
    got = run(spark, traces, chunk_rows=2).orderBy("seq").collect()
    assert [r.t for r in got if r.trace_id == "clock"] == [-11, 53, 54, 55, 10239, 0]
    assert [r.delta for r in got if r.trace_id == "delta"] == [0, 100, 0, -40]


FIFO_CASES = {
    "plain": (10, [0, 100, 100, 60, 0, 50, 0], [(3, 4, 14), (2, 2, 16)]),
    "exact drain with backlog": (0, [100, 150, 50, 0], [(3, 3, 2), (2, 3, 3)]),
    "several in one drain": (0, [10, 30, 0], [(3, 3, 2), (2, 2, 2)]),
    "not finished": (0, [100, 40], []),
}


@pytest.mark.parametrize("chunk_rows", [100, 2, 1])
def test_fifo_golden(spark, chunk_rows):
    traces = {name: levels_at(start, levels) for name, (start, levels, _) in FIFO_CASES.items()}
    seq = run(spark, traces, chunk_rows=chunk_rows)
    packets = completed_packets(seq, chunk_rows=chunk_rows)
    got = packets.orderBy("seq").collect()
    for name, (_, _, want) in FIFO_CASES.items():
        mine = [(r.waiting, r.tx, r.t_done) for r in got if r.trace_id == name]
        assert mine == want, name
    kept = last_per_drain(packets).filter("trace_id = 'several in one drain'").collect()
    assert [(r.slot, r.waiting, r.tx) for r in kept] == [(2, 2, 2)]


FLUSH_CASES = {
    "repeat": (levels_at(97, [9, 9, 5, 0]) + [("r", 100, False), ("r", 105, True)], [(100, 3, 4, 8)]),
    "no repeat": (levels_at(109, [9, 0]) + [("r", 111, True)], [(110, 2, 2, 0)]),
    "same time": (levels_at(109, [9, 0]) + [("r", 110, True)], []),
    "wrap": (levels_at(10234, [9, 0]) + [("r", 3, True)], [(10235, 2, 2, 0)]),
    "orphan repeat": (
        [("r", 50, False), *levels_at(49, [9, 0]), ("r", 60, True)],
        [(50, 2, 2, 8)],
    ),
}


@pytest.mark.parametrize("chunk_rows", [100, 1])
def test_flush_golden(spark, chunk_rows):
    seq = run(spark, {name: c[0] for name, c in FLUSH_CASES.items()}, chunk_rows=chunk_rows)
    got = latency_from_sequence(seq, chunk_rows=chunk_rows).collect()
    for name, (steps, want) in FLUSH_CASES.items():
        mine = [(r.slot, r.waiting, r.tx, r.retx) for r in got if r.trace_id == name]
        assert mine == want == replay(steps).released, name


def test_whole_operator_from_nested_messages(spark):
    def lcid(total):
        return (total, None, None, None)

    def buffer(seq, *samples):
        return ("t", "f", seq, UL_BUFFER, None, None, [([*samples],)])

    def report(seq, *records):
        return ("t", "f", seq, UL_REPORT, None, [(None, None, None, *r) for r in records], None)

    messages = spark.createDataFrame(
        [
            buffer(0, (0, 5, [lcid(7), lcid(100)]), (15, 0, []), (15, 0, [lcid(40)])),
            buffer(1, (3, 5, [lcid(0)])),
            report(2, (53, "Second"), (54, "First")),
        ],
        MESSAGES,
    )
    got = uplink_latency(messages).collect()
    assert [tuple(r) for r in got] == [("t", 53, 3, 4, 8)]


def test_first_above_equals_a_plain_search():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 3, 7, 64, 100):
        values = rng.integers(0, 20, n)
        start = rng.integers(0, n + 1, 200)
        limit = rng.integers(-2, 22, 200)
        want = [
            next((i for i in range(s, n) if values[i] > m), n) for s, m in zip(start, limit)
        ]
        assert first_above(values, start, limit).tolist() == want


def test_missing_fields_of_readings_and_reports(spark):
    """A reading without a frame ticks only, a report without a time releases nothing."""
    sample = lambda n, sub, sys_fn, level: (n, 0, False, sub, sys_fn, level, None, None)
    report = lambda n, time, first: (n, 0, True, None, None, None, time, first)
    rows = [
        sample(0, 3, 5, 0), sample(1, 4, None, 40), sample(2, 15, 0, 10), report(3, None, True),
        sample(4, 6, 5, 0), report(5, 90, False),
    ]
    frame = spark.createDataFrame([("t", "f", *r) for r in rows], ROW_SCHEMA)
    seq = stage(sequence(frame, chunk_rows=2), "test")
    samples = seq.filter("not is_report").orderBy("seq").collect()
    assert [r.t for r in samples] == [53, 54, 55, 56]
    got = latency_from_sequence(seq, chunk_rows=2).collect()
    assert [(r.slot, r.retx) for r in got] == [(56, 0)]


def test_report_without_an_index_is_a_repeat(spark):
    report = ("t", "f", 0, UL_REPORT, None, [(None, None, None, 7, None)], None)
    rows = uplink_rows(spark.createDataFrame([report], MESSAGES), "trace_id").collect()
    assert [r.first_tx for r in rows] == [False]


def test_far_releases_are_found_up_and_down_the_tree(spark):
    """10,000 chunks of one trace; most slots are released only near the end."""
    slots = spark.range(0, 60_000, 6).selectExpr(
        "'t' as trace_id", "id + 1 as seq", "cast(100 + id % 700 as int) as slot",
        "1 as waiting", "1 as tx",
    )
    reports = spark.range(3, 60_000, 6).selectExpr(
        "'t' as trace_id", "id as seq",
        "cast(case when id > 59900 then 900 when id % 1000 = 3 then 400 else 50 end as int) as report_time",
        "true as first_tx",
    )
    got = find_flush(slots, reports, chunk_rows=6).select("seq", "slot", "flush").collect()
    times = {r.seq: r.report_time for r in reports.collect()}
    order = sorted(times)
    want = {}
    nearest = {}
    for seq in sorted((s.seq for s in slots.collect()), reverse=True):
        while order and order[-1] > seq:
            report = order.pop()
            # Nearest later report of each height: a lower one behind a higher never matters.
            nearest = {t: n for t, n in nearest.items() if t > times[report]}
            nearest[times[report]] = report
        slot = 100 + (seq - 1) % 700
        later = [n for t, n in nearest.items() if t > slot]
        if later:
            want[seq] = min(later)
    assert {r.seq: r.flush for r in got} == want and len(want) > 9_000


@pytest.mark.parametrize("fan", [2, 3])
def test_the_tree_of_releases_grows_with_the_trace(spark, fan):
    """A release any number of chunks on is found, with chunks of one row and small groups."""
    gaps = [1, 2, 14, 30, 39, 64, 200]
    slots = spark.createDataFrame([(f"t{g}", 1, 50, 1, 1) for g in gaps], "trace_id string, seq bigint, slot int, waiting int, tx int")
    reports = spark.createDataFrame(
        [(f"t{g}", n, 60 if n == 1 + g else 40, True) for g in gaps for n in range(2, 210)],
        "trace_id string, seq bigint, report_time int, first_tx boolean",
    )
    got = find_flush(slots, reports, chunk_rows=1, fan=fan).collect()
    assert sorted((int(r.trace_id[1:]), r.flush) for r in got) == [(g, 1 + g) for g in gaps]


def test_random_releases_over_many_levels_equal_the_definition(spark):
    rng = random.Random(8)
    rows, want = [], []
    for trace in range(40):
        size = rng.choice([3, 40, 150])
        top = rng.choice([20, 1500])
        for seq in range(1, size + 1):
            rows.append((f"t{trace}", seq, rng.random() < 0.5, rng.randrange(top)))
    by_trace = {}
    for row in rows:
        by_trace.setdefault(row[0], []).append(row)
    for trace, steps in by_trace.items():
        for _, seq, is_report, slot in steps:
            later = [n for _, n, r, t in steps if r and n > seq and (slot < t or (slot > 1000 and t < 20))]
            if not is_report and later:
                want.append((trace, seq, min(later)))
    frame = spark.createDataFrame(rows, "trace_id string, seq bigint, is_report boolean, value int")
    slots = frame.filter("not is_report").selectExpr("trace_id", "seq", "value as slot", "1 as waiting", "1 as tx")
    reports = frame.filter("is_report").selectExpr("trace_id", "seq", "value as report_time", "true as first_tx")
    got = find_flush(slots, reports, chunk_rows=1, fan=2)
    assert sorted(map(tuple, got.select("trace_id", "seq", "flush").collect())) == sorted(want)
    assert len(want) > 500
