"""Session settings the library expects."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors, once per application.

    Python functions of the operators are pickled by name, so executors import
    them; where nothing else installs the package there, this does.
    """
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        archive = shutil.make_archive(
            os.path.join(tempfile.mkdtemp(prefix="cellmeter-ship-"), "cellmeter_package"),
            "zip",
            os.path.dirname(package),
            os.path.basename(package),
        )
        spark.sparkContext.addPyFile(archive)  # Spark's own file server hands it out
        _shipped.add(application)


def get_session(app_name: str = "cellmeter", **overrides: str) -> SparkSession:
    """A session with UTC time and adaptive execution.

    Cluster sizing (executors, shuffle partitions, ``spark.checkpoint.dir``)
    is left to spark-submit; pass ``overrides`` for anything set in code.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def local_session(cores: int | str = 8, **overrides: str) -> SparkSession:
    """Single-JVM session for tests and the benchmark."""
    settings = {
        "spark.master": f"local[{cores}]",
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("CELLMETER_DRIVER_MEMORY", "12g"),
        "spark.sql.shuffle.partitions": "8",
        **overrides,
    }
    return get_session("cellmeter-local", **settings)
