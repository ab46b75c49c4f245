"""Worked cases of the simple operators, and the histogram against numpy."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellmeter.functions.dicttext import CORRUPT
from cellmeter.functions.radio import circular_diff, fix_report_time, last_lcid
from cellmeter.operators import batches, filters, histogram, latency, queues, records, topk
from cellmeter.operators.scan import next_value, ordered_sums
from cellmeter.schemas import CUSTOM, DL_STAT, MESSAGES, UL_REPORT
from cellmeter.sources.messages import parse_lines

TS = dt.datetime(2023, 11, 14, 22, 13, 20, 250000)


def downlink(spark, *record_lists):
    rows = [
        ("t", "f", i, DL_STAT, TS, [(*r, None, None) for r in rs], None)
        for i, rs in enumerate(record_lists)
    ]
    return spark.createDataFrame(rows, MESSAGES)


def test_dict_text_line_to_samples(spark):
    line = (
        "{'timestamp': 1700000000.25, 'Records': [{'Frame Num': 3, 'Subframe Num': 1, "
        "'Num RBs': 12, 'ok': True, 'n': None}, {'Frame Num': 3}]}"
    )
    rows = spark.createDataFrame([(line,), ("{'timestamp': 17",)], "line string")
    parsed = parse_lines(rows)
    good, bad = filters.split_malformed(parsed, CORRUPT)
    assert bad.count() == 1
    messages = good.withColumn("ts", F.timestamp_micros((F.col("timestamp") * 1e6).cast("bigint")))
    assert [tuple(r) for r in records.rb_samples(messages).collect()] == [(1700000000.25, 12)]


def test_words_inside_strings_stay(spark):
    rows = spark.createDataFrame([("{'type_id': 'None True', 'timestamp': None}",)], "line string")
    got = parse_lines(rows).first()
    assert (got.type_id, got.timestamp) == ("None True", None)


def test_sequential_samples(spark):
    messages = downlink(
        spark, [(1, 0, 4), (1, 1, 6), (1, 3, 2), (1, 4, 9), (1, 5, 7)], [(1, 0, 4)], []
    )
    got = [r.num_rbs for r in records.sequential_rb_samples(messages).collect()]
    assert got == [4, 2]
    loose = records.sequential_rb_samples(messages, strict_bound=False)
    assert [r.num_rbs for r in loose.collect()] == [4, 2, 9]


def test_scalar_rules(spark):
    row = spark.range(1).select(
        *[fix_report_time(F.lit(v)).alias(f"r{i}") for i, v in enumerate([-3, 0, 7])],
        *[
            circular_diff(F.lit(a), F.lit(b)).alias(f"d{i}")
            for i, (a, b) in enumerate([(11, 13), (5, 5), (10239, 2)])
        ],
        last_lcid(F.array(F.lit(1), F.lit(4))).alias("last"),
        last_lcid(F.array().cast("array<int>")).alias("none"),
    ).first()
    assert tuple(row) == (1021, 0, 7, 3, 1, 3, 4, None)


def test_totals_and_spans(spark):
    samples = spark.createDataFrame(
        [(1, 100.9, 5), (1, 220.2, 7), (2, 220.2, 3)], "batch_id int, ts double, num_rbs int"
    )
    got = {r.batch_id: tuple(r)[1:] for r in batches.utilization(samples, ["batch_id"]).collect()}
    assert got == {1: (12, 100, 220, 2.0), 2: (3, 220, 220, 0.0)}
    assert batches.utilization(samples.filter("false")).count() == 0


def test_subscription(spark):
    rows = spark.createDataFrame([("a",), ("b",), (CUSTOM,)], "type_id string")
    assert sorted(r[0] for r in filters.subscribe(rows, "a").collect()) == [CUSTOM, "a"]
    assert filters.subscribe_all(rows, ["a", "b"]).count() == 3


def test_report_counts(spark):
    rows = [("t", "f", 0, UL_REPORT, TS, [(None, None, None, -3, i) for i in ("First", "First", "Third")], None)]
    reports = records.report_records(spark.createDataFrame(rows, MESSAGES))
    assert tuple(latency.block_counts(reports).first()) == (2, 1)
    assert {r.report_time for r in reports.collect()} == {1021}


def test_latency_tables(spark):
    by_batch = spark.createDataFrame(
        [(1, 2, 5, 8), (2, 1, 1, 0)], "batch_no int, waiting long, tx long, retx long"
    )
    running = latency.latency_running(by_batch).orderBy("batch_no").collect()
    assert [tuple(r) for r in running] == [(1, 2, 5, 8), (2, 3, 6, 8)]
    bars = {(r.batch_no, r.part): (r.height, r.bottom) for r in latency.latency_stack(by_batch).collect()}
    assert bars[1, "waiting"] == (2, 0) and bars[1, "tx"] == (5, 2) and bars[1, "retx"] == (8, 7)
    assert tuple(latency.latency_sums(by_batch.filter("false")).first()) == (0, 0, 0)


def test_top_with_other(spark):
    sizes = {"a": 5, "b": 4, "c": 3, "d": 2, "e": 1, "x": 99}
    rows = spark.createDataFrame(list(sizes.items()), "k string, v long")
    got = topk.top_with_other(rows, "k", F.col("v"), k=3, exclude=["x"]).collect()
    assert {(r.kind, r.rank, r.label, r.n_keys, r["size"]) for r in got} == {
        ("top", 1, "a", 1, 5), ("top", 2, "b", 1, 4), ("top", 3, "c", 1, 3),
        ("other", None, None, 2, 3), ("total", None, None, 5, 15),
    }
    few = topk.top_with_other(rows, "k", F.col("v"), k=9).collect()
    assert {r.kind for r in few} == {"top", "total"}


@pytest.mark.parametrize("integral", [True, False])
def test_histogram_is_numpys(spark, integral):
    rng = np.random.default_rng(7)
    groups = {}
    for g in range(60):
        n = int(rng.integers(1, 300))
        kind = g % 4
        if kind == 0:
            x = rng.integers(0, 100, n)
        elif kind == 1:
            x = rng.poisson(5, n)
        elif kind == 2:
            x = np.full(n, 7)
        else:
            x = np.where(rng.random(n) < 0.9, 3, rng.integers(0, 5000, n))
        groups[g] = x.astype(np.int64) if integral else x * 0.37
    rows = spark.createDataFrame(
        [(g, v.item()) for g, x in groups.items() for v in x],
        f"g int, v {'long' if integral else 'double'}",
    )
    got = {}
    for r in histogram.auto_histogram(rows, "v", ["g"]).collect():
        got.setdefault(r.g, []).append(r)
    for g, x in groups.items():
        density, edges = np.histogram(x, bins="auto", density=True)
        counts, _ = np.histogram(x, bins="auto")
        bins = sorted(got[g], key=lambda r: r.bin)
        assert [r.n for r in bins] == counts.tolist(), g
        assert np.allclose([r.lo for r in bins], edges[:-1])
        assert np.allclose([r.hi for r in bins], edges[1:])
        assert np.allclose([r.density for r in bins], density)


def test_histogram_of_a_million_doubles_equals_numpy(spark):
    rows = spark.range(1_000_000).selectExpr("cast(log(1 + (id * 7919) % 1000003) * 3 as double) as v")
    x = np.array([r.v for r in rows.collect()])
    assert len(np.unique(x)) == 1_000_000
    counts, edges = np.histogram(x, bins="auto")
    got = histogram.auto_histogram(rows.repartition(20), "v").orderBy("bin").collect()
    assert [r.n for r in got] == counts.tolist()
    assert np.allclose([r.lo for r in got], edges[:-1], rtol=1e-12)


def test_histograms_of_counts_and_of_nothing(spark):
    rows = spark.createDataFrame([(1, 5), (1, 5), (2, 6), (3, None)], "b int, v int")
    counts = histogram.value_counts(rows, "v", ["b"])
    assert sorted(map(tuple, counts.collect())) == [(1, 5, 2), (2, 6, 1)]
    plain = sorted(map(tuple, histogram.auto_histogram(rows, "v").collect()))
    assert sorted(map(tuple, histogram.auto_histogram(counts, "v", weight="n").collect())) == plain
    assert sum(r[3] for r in plain) == 3
    for nothing in (rows.limit(0), rows.filter("b = 3")):
        assert histogram.auto_histogram(nothing, "v").count() == 0
        assert histogram.auto_histogram(nothing, "v", ["b"]).count() == 0


def test_sums_over_ranges_of_the_order(spark):
    rng = random.Random(6)
    data = [(rng.choice("ab"), rng.randrange(400), rng.choice([None, -3, 7])) for _ in range(900)]
    data = list({(k, i): (k, i, v) for k, i, v in data}.values())
    rows = spark.createDataFrame(data, "k string, i int, v int").repartition(7)
    for by in ([], ["k"]):
        got = ordered_sums(rows, ["i", "k"], {"n": F.lit(1), "s": F.col("v")}, by, totals=True)
        for r in got.collect():
            mine = [(i, k, v or 0) for k, i, v in data if not by or k == r.k]
            upto = [v for i, k, v in mine if (i, k) <= (r.i, r.k)]
            assert (r.n, r.s) == (len(upto), sum(upto))
            assert (r.n_all, r.s_all) == (len(mine), sum(v for *_, v in mine))
    assert ordered_sums(rows.limit(0), ["i"], {"n": F.lit(1)}).count() == 0


def test_queues_meet_in_order(spark):
    rng = random.Random(2)
    rows, queues_left = [], {}
    for seq in range(600):
        key, side = rng.choice("aaaaaab"), rng.choice([1, 2, 2])
        rows.append((key, seq, side))
        mine, other = queues_left.setdefault((key, side), []), queues_left.setdefault((key, 3 - side), [])
        if other:
            other.pop(0)
        else:
            mine.append(seq)
    frame = spark.createDataFrame(rows, "k string, seq long, side int")
    want = sorted(seq for left in queues_left.values() for seq in left)
    for chunk_rows in (7, 1 << 18):
        got = queues.unmatched(frame, ["k"], chunk_rows=chunk_rows)
        assert sorted(r.seq for r in got.collect()) == want


def test_chunked_scans_equal_plain_ones(spark):
    rng = random.Random(4)
    data = [(k, i, rng.choice([None, None, i])) for k in "ab" for i in range(50)]
    rows = spark.createDataFrame(data, "k string, i long, v long").withColumn(
        "c", F.expr("i div 6")
    )
    summed = ordered_sums(rows, ["i"], {"s": F.col("v")}, by=["k"])
    filled = next_value(rows, ["k"], ["c"], ["i"], F.col("v"), "nxt", F.col("i"))
    sums = {(r.k, r.i): r.s for r in summed.collect()}
    fills = {(r.k, r.i): r.nxt for r in filled.collect()}
    for k, i, _ in data:
        mine = [(j, v) for kk, j, v in data if kk == k]
        assert sums[k, i] == sum(v or 0 for j, v in mine if j <= i)
        assert fills[k, i] == next((v for j, v in mine if j >= i and v is not None), None)


def test_file_bookkeeping(spark):
    listing = spark.createDataFrame([("a",), ("b",), ("b",)], "file_name string")
    visited = spark.createDataFrame([("a",)], "file_name string")
    new = batches.new_files(listing, visited)
    assert [r[0] for r in new.collect()] == ["b"]
    assert sorted(r[0] for r in batches.visited_union(visited, new).collect()) == ["a", "b"]
    hours = spark.createDataFrame([("x", True), ("y", False), ("z", True)], "b string, d boolean")
    got = batches.number_batches(hours, "b", "d").collect()
    assert sorted((r.b, r.batch_no) for r in got) == [("x", 1), ("z", 2)]
    values = spark.createDataFrame([("k", 1, 9), ("k", 2, 4)], "k string, o int, v int")
    assert batches.last_value(values, ["k"], "v", "o").first().last_value == 4
