"""Type subscription and malformed-row handling."""

from __future__ import annotations

import warnings
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import CUSTOM, KNOWN_TYPES


def subscribe(
    messages: DataFrame, types: str | Iterable[str], known: Iterable[str] = KNOWN_TYPES
) -> DataFrame:
    """Messages of the enabled types; custom packets always pass.

    A name that isn't ``known`` is warned of, and enabled all the same.
    """
    names = [types] if isinstance(types, str) else list(types)
    supported = {*known, CUSTOM}
    for name in dict.fromkeys(names):
        if name not in supported:
            warnings.warn(f"unsupported message type: {name}", stacklevel=2)
    wanted = list(dict.fromkeys([*names, CUSTOM]))
    return messages.filter(F.col("type_id").isin(wanted))


def subscribe_all(messages: DataFrame, known: Iterable[str] = KNOWN_TYPES) -> DataFrame:
    """Messages of every supported type."""
    known = list(known)
    return subscribe(messages, known, known)


def available_types(messages: DataFrame) -> DataFrame:
    return messages.select("type_id").distinct()


def unknown_types(requested: DataFrame, known: DataFrame) -> DataFrame:
    """Requested type names that nothing supports."""
    return requested.distinct().join(known, "type_id", "left_anti")


def split_malformed(rows: DataFrame, corrupt: str) -> tuple[DataFrame, DataFrame]:
    """Good rows without the corrupt column, and the rejected rows."""
    good = rows.filter(F.col(corrupt).isNull()).drop(corrupt)
    return good, rows.filter(F.col(corrupt).isNotNull())
