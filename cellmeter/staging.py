"""Intermediate tables in the cluster's shared checkpoint folder.

A table that several later steps read is written once as Parquet. That cuts the
lineage, survives the loss of executors and lets each reader prune columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


_open_paths: ContextVar[list[str] | None] = ContextVar("open_paths", default=None)


def staging_root(spark: SparkSession) -> str:
    """This application's folder under ``spark.checkpoint.dir``, else in the warehouse.

    ``spark.checkpoint.dir`` is the folder all executors share; naming it is the
    cluster's say, and a path without a scheme or a ``file:`` path there may well
    be a shared mount. Where it is unset, the warehouse has to be in a store:
    a local folder of the driver is refused unless everything runs in one process.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        if root.startswith(("file:", "/")) and not context.master.startswith("local"):
            raise ValueError(
                f"set spark.checkpoint.dir to a folder all executors share: {root} is the driver's own"
            )
    return f"{root.rstrip('/')}/cellmeter-{context.applicationId}"


def stage(
    df: DataFrame, name: str, level: int = 3, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write ``df`` below the staging folder, at a level of zstandard, and read it back."""
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"
    opened = _open_paths.get()
    if opened is not None:
        opened.append(path)
    writer = df.write.mode("errorifexists").option("compression", "zstd")
    writer = writer.option("parquet.compression.codec.zstd.level", level)
    writer.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, or anything that a pattern matches."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no folder."""
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(target))


def delete_path(spark: SparkSession, path: str) -> None:
    system, target = _file_system(spark, path)
    system.delete(target, True)


Keep = Callable[[DataFrame, str], DataFrame]


@contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[Keep]:
    """Delete the tables staged inside the block when it ends.

    Everything that reads them has to be written by then. The block is given a
    function that stages a table for longer: as if it were outside.
    """
    paths: list[str] = []
    outer = _open_paths.get()
    token = _open_paths.set(paths)

    def keep(df: DataFrame, name: str) -> DataFrame:
        inner = _open_paths.set(outer)
        try:
            return stage(df, name)
        finally:
            _open_paths.reset(inner)

    try:
        yield keep
    finally:
        _open_paths.reset(token)
        for path in paths:
            delete_path(spark, path)


def release(spark: SparkSession) -> None:
    """Delete this application's staged tables, once their results are written."""
    delete_path(spark, staging_root(spark))
