"""Result and message sinks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import epoch_seconds
from ..operators.filters import subscribe


def write_lines(messages: DataFrame, path: str) -> None:
    """One JSON object per message and line; ``ts`` becomes ``timestamp`` in epoch seconds.

    The line reader takes JSON as it takes dict-text, so it reads these back.
    """
    columns = [
        epoch_seconds(F.col(c)).alias("timestamp") if c == "ts" else F.col(c)
        for c in messages.columns
    ]
    lines = messages.select(F.to_json(F.struct(*columns)).alias("value"))
    lines.write.mode("overwrite").text(path)


def export_types(messages: DataFrame, types: str | Iterable[str], path: str) -> None:
    """Only the enabled types, one folder per type."""
    subscribe(messages, types).write.mode("overwrite").partitionBy("type_id").parquet(path)


def write_batch(table: DataFrame, path: str, name: str, batch_id: int) -> None:
    """One batch of a result table; writing the batch again replaces it."""
    table.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")


def write_table(table: DataFrame, path: str, name: str) -> None:
    """A whole result table in place of what the last run left."""
    table.write.mode("overwrite").parquet(f"{path}/{name}")
