"""Message files as tables or as a stream."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dicttext import CORRUPT, parse_dict_text
from ..schemas import MESSAGES, TEXT_LINE
from ..staging import path_exists


def file_name() -> Column:
    """Name of the file a row was read from."""
    return F.col("_metadata.file_name").alias("file_name")


def scan_directory(
    spark: SparkSession,
    path: str,
    suffixes: Iterable[str],
    fmt: str = "parquet",
    schema: str = MESSAGES,
) -> DataFrame:
    """One table, or a directory's direct children with one of the suffixes.

    A child may be a file or a folder of part files, as large tables are. A path
    that isn't there and a directory without such a child give an empty table.
    """
    suffixes = list(suffixes)
    found = path if _is_named(path, suffixes) else _children(path, suffixes)
    if not path_exists(spark, found):
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).load(found)


def _is_named(path: str, suffixes: list[str]) -> bool:
    return any(path.rstrip("/").endswith(s) for s in suffixes)


def _children(path: str, suffixes: list[str]) -> str:
    """Pattern of the direct children with one of the suffixes, files or folders."""
    return f"{path.rstrip('/')}/*{{{','.join(suffixes)}}}"


def scan_files(
    spark: SparkSession,
    directory: str,
    names: Iterable[str],
    fmt: str = "parquet",
    schema: str = MESSAGES,
) -> DataFrame:
    """Exactly the named files of a directory; a missing one is an error."""
    paths = [f"{directory.rstrip('/')}/{name}" for name in sorted(set(names))]
    return spark.read.format(fmt).schema(schema).load(paths)


def message_stream(
    spark: SparkSession,
    path: str,
    suffixes: Iterable[str],
    fmt: str = "parquet",
    schema: str = MESSAGES,
    max_files: int | None = None,
) -> DataFrame:
    """New files of a directory as a stream; the checkpoint remembers the used ones.

    The files of a child that is a folder are files of the stream.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(_children(path, list(suffixes)))


def read_lines(
    spark: SparkSession,
    path: str,
    suffixes: Iterable[str] = (".txt",),
    name: Column | None = None,
) -> DataFrame:
    """Text files as ``file_name, msg_seq, line``, blank lines left out.

    Files are read in blocks, by as many tasks as a file has blocks, so their size
    has no limit. ``msg_seq`` grows along a file as its lines do, see
    ``numbered_lines``. ``name`` is what ``file_name`` shows, by default the
    file's name without its folder.
    """
    return numbered_lines(spark.read.option("pathGlobFilter", _glob(suffixes)).text(path), name)


def line_stream(
    spark: SparkSession,
    path: str,
    suffixes: Iterable[str] = (".txt",),
    name: Column | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """New text files of a directory as a stream of ``read_lines`` rows."""
    reader = spark.readStream.format("text").option("pathGlobFilter", _glob(suffixes))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return numbered_lines(reader.load(path), name)


def _glob(suffixes: Iterable[str]) -> str:
    return "*{" + ",".join(suffixes) + "}"


def numbered_lines(files: DataFrame, name: Column | None = None) -> DataFrame:
    """Rows of Spark's text source, numbered along each file without a shuffle.

    A task reads a block of a file from its first line to its last, so the lines
    before one in its block can be counted as they pass. The number is the block's
    first byte plus that count. A line takes a byte at least, so numbers grow from
    block to block; they have gaps, and depend on how Spark cuts the files.
    """
    blocks = files.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("begin"),
        (file_name() if name is None else name).alias("file_name"),
        F.col("value").alias("line"),
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, passed = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            begin = batch.column("begin").to_numpy()
            path = batch.column("path").dictionary_encode()
            # The first line of a later block begins behind its first byte.
            place = np.where(begin > 0, begin + 1, 0)
            same = path.indices.to_numpy()
            starts = np.flatnonzero(np.r_[True, (begin[1:] != begin[:-1]) | (same[1:] != same[:-1])])
            inside = np.arange(len(begin)) - np.repeat(starts, np.diff(np.r_[starts, len(begin)]))
            if (path[0].as_py(), begin[0]) == block:
                first = starts[1] if len(starts) > 1 else len(begin)
                inside[:first] += passed
            block, passed = (path[len(begin) - 1].as_py(), begin[-1]), int(inside[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("file_name"), pa.array(place + inside), batch.column("line")],
                ["file_name", "msg_seq", "line"],
            )

    numbered = blocks.mapInArrow(count, "file_name string, msg_seq bigint, line string")
    return numbered.filter(F.col("line") != "")


def line_messages(lines: DataFrame, trace: Column | None = None) -> DataFrame:
    """Dict-text lines to ``MESSAGES``, batch or stream; lines that don't parse are left out.

    ``trace`` names the trace of a line, by default what the line says, else the
    file it is in.
    """
    parsed = parse_lines(lines).filter(F.col(CORRUPT).isNull())
    micros = F.round(F.col("timestamp") * 1e6).cast("bigint")
    named = F.coalesce("trace_id", "file_name") if trace is None else trace
    return parsed.select(
        named.alias("trace_id"),
        "file_name",
        "msg_seq",
        "type_id",
        F.timestamp_micros(micros).alias("ts"),
        "Records",
        "Subpackets",
    )


def parse_lines(lines: DataFrame, schema: str = TEXT_LINE) -> DataFrame:
    """Dict-text lines to columns; ``_corrupt`` holds a line that did not parse."""
    others = [c for c in lines.columns if c != "line"]
    return lines.select(*others, parse_dict_text(F.col("line"), schema).alias("m")).select(
        *others, "m.*"
    )

