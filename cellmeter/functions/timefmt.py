"""Epoch seconds and the text labels of results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NTZ_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def epoch_seconds(ts: Column) -> Column:
    """TIMESTAMP to epoch seconds with the microsecond fraction."""
    return F.unix_micros(ts) / F.lit(1e6)


def utc_instant(ts_ntz: str) -> Column:
    """Read a zone-less timestamp column as UTC, whatever the session zone."""
    return F.expr(
        f"timestamp_micros(timestampdiff(MICROSECOND, {_NTZ_EPOCH}, `{ts_ntz}`))"
    )


def utc_text(seconds: Column) -> Column:
    """Whole epoch seconds as ``YYYY-MM-DD HH:MM:SS`` in UTC."""
    return F.timestamp_add("SECOND", seconds, F.expr(_NTZ_EPOCH)).cast("string")


def minutes_between(min_ts: Column, max_ts: Column) -> Column:
    return F.round((max_ts - min_ts) / F.lit(60), 3)


# Wording of the result labels.
UTILIZATION_LABEL = "Channel Utilization starting %s (Duration: %s min)"
TOTAL_UTILIZATION_LABEL = "Channel Utilization from %s to %s (Duration: %s min)"
RB_LABEL = "Number of Resource Blocks (%s Total Resource Blocks in Time Window)"
LATENCY_LABEL = "Latency Breakdown from %s to %s (Duration: %s min)"


def span_labels(min_ts: Column, max_ts: Column, total_rbs: Column) -> dict[str, Column]:
    """Label columns for one covered span."""
    start, end = utc_text(min_ts), utc_text(max_ts)
    minutes = minutes_between(min_ts, max_ts).cast("string")
    return {
        "utilization_label": F.format_string(UTILIZATION_LABEL, start, minutes),
        "total_label": F.format_string(TOTAL_UTILIZATION_LABEL, start, end, minutes),
        "rb_label": F.format_string(RB_LABEL, total_rbs),
        "latency_label": F.format_string(LATENCY_LABEL, start, end, minutes),
    }
