"""Files in, files out."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cellmeter.operators import filters
from cellmeter.schemas import DL_STAT, MESSAGES, UL_REPORT
from cellmeter.sources import messages as source
from cellmeter.sources import sinks

SCHEMA = "trace_id string, file_name string, msg_seq bigint, type_id string"


@pytest.fixture
def some(spark):
    rows = [("t", f"f{i % 2}", i, [DL_STAT, UL_REPORT, "other"][i % 3]) for i in range(9)]
    return spark.createDataFrame(rows, SCHEMA)


def test_directory_scan_takes_direct_children_with_the_suffix(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"msg_seq": 1}\n{"msg_seq": 2}\n')
    (tmp_path / "b.jsonl").write_text('{"msg_seq": 3}\n')
    (tmp_path / "c.json").write_text('{"msg_seq": 4}\n')
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "d.jsonl").write_text('{"msg_seq": 5}\n')
    scan = lambda p: source.scan_directory(spark, str(p), [".jsonl"], "json", SCHEMA)
    assert sorted(r.msg_seq for r in scan(tmp_path).collect()) == [1, 2, 3]
    assert scan(tmp_path / "b.jsonl").count() == 1
    assert scan(tmp_path / "nowhere").count() == 0
    (tmp_path / "none").mkdir()
    assert scan(tmp_path / "none").count() == 0


def test_directory_scan_reads_folder_tables(spark, tmp_path):
    spark.range(10).repartition(3).selectExpr("id as msg_seq").write.parquet(
        str(tmp_path / "events.parquet")
    )
    spark.range(4).selectExpr("id as msg_seq").write.parquet(str(tmp_path / "other.parquet"))
    scan = lambda p, s: source.scan_directory(spark, str(p), s, schema="msg_seq bigint")
    assert scan(tmp_path, ["events.parquet"]).count() == 10
    assert scan(tmp_path, [".parquet"]).count() == 14
    assert scan(tmp_path / "events.parquet", [".parquet"]).count() == 10
    stream = source.message_stream(spark, str(tmp_path), ["events.parquet"], schema="msg_seq bigint")
    query = stream.writeStream.format("memory").queryName("seen").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("seen").count() == 10


def test_file_set_scan(spark, tmp_path):
    for name in "abc":
        (tmp_path / f"{name}.json").write_text('{"msg_seq": 1}\n')
    got = source.scan_files(spark, str(tmp_path), {"a.json", "c.json"}, "json", SCHEMA)
    names = got.select(source.file_name()).distinct().collect()
    assert sorted(r.file_name for r in names) == ["a.json", "c.json"]
    with pytest.raises(AnalysisException):
        source.scan_files(spark, str(tmp_path), {"a.json", "z.json"}, "json", SCHEMA).count()


def test_text_lines_keep_their_number(spark, tmp_path):
    (tmp_path / "log.txt").write_text("{'timestamp': 1.5}\n{'timestamp': 2.5}\n{'times\n")
    got = source.parse_lines(source.read_lines(spark, str(tmp_path))).orderBy("msg_seq").collect()
    assert [(r.file_name, r.msg_seq, r.timestamp) for r in got] == [
        ("log.txt", 0, 1.5), ("log.txt", 1, 2.5), ("log.txt", 2, None),
    ]
    assert [r._corrupt is None for r in got] == [True, True, False]


def test_strings_in_lines_keep_their_words(spark):
    lines = [
        """{'a': 'None or True', 'b': "it's True", 'ok': True}""",
        """{'a': 'x\\'s None', 'b': "q", 'ok': False}""",
        """{'a': None, 'b': 'True', 'ok': None}""",
        "{'a': 'broken",
    ]
    frame = spark.createDataFrame([(x,) for x in lines], "line string")
    got = source.parse_lines(frame, "a string, b string, ok boolean").collect()
    assert [tuple(r)[:3] for r in got] == [
        ("None or True", "it's True", True), ("x's None", "q", False), (None, "True", None),
        (None, None, None),
    ]
    assert [r._corrupt is None for r in got] == [True, True, True, False]


def test_messages_survive_the_line_sink(spark, tmp_path):
    ts = dt.datetime(2024, 1, 2, 3, 4, 5, 250_000)
    rows = [("m.txt", "m.txt", i, DL_STAT, ts, [(1, 2, i, None, None)], None) for i in range(3)]
    messages = spark.createDataFrame(rows, MESSAGES)
    sinks.write_lines(messages.coalesce(1), str(tmp_path / "out"))
    lines = source.read_lines(spark, str(tmp_path / "out"))
    back = source.line_messages(lines, F.lit("m.txt")).orderBy("msg_seq").collect()
    assert [(r.msg_seq, r.type_id, r.ts, r.Records[0]["Num RBs"]) for r in back] == [
        (i, DL_STAT, ts, i) for i in range(3)
    ]


def test_line_sink_round_trip(spark, some, tmp_path):
    path = str(tmp_path / "lines")
    sinks.write_lines(some, path)
    sinks.write_lines(some, path)
    back = spark.read.schema(SCHEMA).json(path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, some.collect()))


def test_filtered_export(spark, some, tmp_path):
    path = str(tmp_path / "export")
    sinks.export_types(some, [DL_STAT], path)
    back = spark.read.parquet(path)
    assert back.count() == 3 and {r.type_id for r in back.collect()} == {DL_STAT}


def test_tables_replace_what_was_there(spark, some, tmp_path):
    out = str(tmp_path)
    for _ in range(2):
        sinks.write_batch(some, out, "rows", 4)
        sinks.write_table(some, out, "all")
    assert spark.read.parquet(f"{out}/rows").filter("batch_id = 4").count() == 9
    assert spark.read.parquet(f"{out}/all").count() == 9


def test_lines_of_files_in_many_blocks_keep_their_order(spark, tmp_path):
    """Files cut into blocks inside lines; the numbers follow the lines."""
    rng = random.Random(3)
    texts = {}
    for name, count in (("big", 4000), ("small", 3), ("other", 900), ("one", 1)):
        lines = ["%s %d %s" % (name, i, "x" * rng.choice([0, 3, 200])) for i in range(count)]
        end = "\r\n" if name == "other" else "\n"
        texts[f"{name}.txt"] = lines
        blanks = end * 40 if name == "big" else ""
        (tmp_path / f"{name}.txt").write_bytes((blanks + end.join(lines)).encode())
    (tmp_path / "left.log").write_text("no")
    settings = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "10"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        read = source.read_lines(spark, str(tmp_path))
        assert read.rdd.getNumPartitions() > 50
        rows = read.collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    got = {}
    for row in sorted(rows, key=lambda r: (r.file_name, r.msg_seq)):
        got.setdefault(row.file_name, []).append(row.line)
    assert got == texts
    assert len({(r.file_name, r.msg_seq) for r in rows}) == len(rows)


def test_a_block_of_blank_lines_shares_no_number(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\n" * 100 + "x\ny\n" + "\n" * 50 + "z")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20")
    try:
        rows = source.read_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.line for r in sorted(rows, key=lambda r: r.msg_seq)] == ["x", "y", "z"]


def test_unknown_types_are_warned_of(some):
    with pytest.warns(UserWarning, match="unsupported message type: nothing"):
        assert filters.subscribe(some, ["nothing", UL_REPORT]).count() == 3
