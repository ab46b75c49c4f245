"""Plan properties that matter on large tables."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from cellmeter.operators.fifo import match_drains
from cellmeter.operators.flush import find_flush
from cellmeter.operators.records import rb_samples, uplink_rows
from cellmeter.operators.sequence import sequence
from cellmeter.plans import tables
from cellmeter.plans.queries import QUERIES
from cellmeter.schemas import SUBPACKETS
from cellmeter.staging import stage


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(text):
    return text.split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def messages(spark, sf_dir):
    return tables.uplink_messages(spark, sf_dir)


def test_sequence_reads_its_input_twice_at_most(spark, messages):
    """Once to count rows and once for the rows, which also give the chunk rows."""
    rows = uplink_rows(messages, "trace_id")
    plan = final_plan(executed(sequence(rows)))
    assert plan.count("FileScan") <= 2 and "ReusedExchange" in plan


def test_chunks_are_bounded_in_rows_and_filled(spark):
    sample = "named_struct('Sub FN', 1, 'Sys FN', 2, 'LCIDs', array(named_struct('Total Bytes', 5L)))"
    messages = spark.range(600).selectExpr(
        "'t' as trace_id", "concat('f', id div 3) as file_name", "id as msg_seq",
        "'LTE_MAC_UL_Buffer_Status_Internal' as type_id",
        f"array(named_struct('Samples', array_repeat({sample}, 50))) as Subpackets",
        "cast(null as array<struct<`Current SFN SF`:int,`Re-tx Index`:string>>) as Records",
    )
    plan_rows = []
    for chunk_rows in (4_000, 70):
        seq = sequence(uplink_rows(messages, "trace_id"), chunk_rows=chunk_rows)
        sizes = seq.groupBy(((F.col("seq") - 1) / chunk_rows).cast("bigint")).count().collect()
        plan_rows.append([r["count"] for r in sizes])
    for chunk_rows, sizes in zip((4_000, 70), plan_rows):
        assert sum(sizes) == 30_000 and max(sizes) <= chunk_rows
        assert sum(sizes) / len(sizes) >= chunk_rows / 2


def test_lookahead_windows_never_end_at_the_last_row(spark, messages):
    seq = stage(sequence(uplink_rows(messages, "trace_id"), chunk_rows=16), "test")
    matched = match_drains(seq, chunk_rows=16)
    slots = seq.filter("delta < 0").selectExpr(
        "trace_id", "seq", "t as slot", "1 as waiting", "1 as tx"
    )
    flushed = find_flush(slots, seq.filter("is_report"), chunk_rows=16)
    for df in (seq, matched, flushed):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "unboundedfollowing" not in plan.lower()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_type_filter_and_columns_reach_the_scan(spark, tmp_path, messages):
    path = str(tmp_path / "m")
    messages.write.parquet(path)
    found = spark.read.parquet(path).filter("type_id = 'LTE_PHY_PUSCH_Tx_Report'")
    plan = final_plan(executed(found.select("msg_seq")))
    assert "EqualTo(type_id,LTE_PHY_PUSCH_Tx_Report)" in plan
    assert re.search(r"ReadSchema: struct<msg_seq:bigint,type_id:string>", plan)


def scanned_fields(plan):
    return re.search(r"ReadSchema: (struct<.*)", plan).group(1).split("\n")[0]


def test_scans_read_only_the_record_fields_they_use(spark, sf_dir, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    path = str(tmp_path / "d")
    tables.downlink_messages(spark, sf_dir).write.parquet(path)
    stored = spark.read.parquet(path)
    samples = scanned_fields(executed(rb_samples(stored, "batch_id")))
    assert "Num RBs" in samples and "Frame Num" not in samples
    stored = stored.selectExpr("*", f"cast(null as {SUBPACKETS}) as Subpackets")
    reports = scanned_fields(executed(uplink_rows(stored, "trace_id")))
    assert "Current SFN SF" in reports and "Num RBs" not in reports


@pytest.mark.parametrize(
    "name",
    [
        "rb_total_by_batch", "rb_histogram", "rb_histogram_by_batch", "topk_with_other",
        "queue_match_unmatched", "latency_running",
    ],
)
def test_no_pairwise_joins(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def lone_tasks(plan):
    """Operators above an exchange to a single partition that are no aggregates."""
    lines = [re.sub(r"^[\s:+|-]*(\*\(\d+\) )?", "", line) for line in plan.splitlines()]
    nodes = [line for line in lines if line]
    above = []
    for i, node in enumerate(nodes):
        if "SinglePartition" in node:
            # Sorts and readers of the shuffle do no work of their own.
            passed = (n for n in reversed(nodes[:i]) if not n.startswith(("Sort ", "AQEShuffleRead", "ShuffleQueryStage")))
            above.append(next(passed, ""))
    return [n for n in above if "Aggregate" not in n]


@pytest.mark.parametrize(
    "name",
    [
        "ordered_messages", "batch_numbering", "latency_by_batch", "latency_running",
        "latency_total", "latency_stack", "rb_histogram", "rb_histogram_by_batch",
    ],
)
def test_no_table_is_put_into_one_task(spark, sf_dir, name):
    plan = final_plan(executed(QUERIES[name](spark, sf_dir)))
    assert not lone_tasks(plan), lone_tasks(plan)
    assert "percentile" not in plan
