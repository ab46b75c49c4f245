"""Frame-clock arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 1024 frames of 10 subframes make one clock period.
SUBFRAMES = 10
FRAMES = 1024
CLOCK_PERIOD = FRAMES * SUBFRAMES
NO_CLOCK = -11


def frame_index(frame: Column, subframe: Column) -> Column:
    """Position of a subframe on the frame clock."""
    return frame * SUBFRAMES + subframe


def circular_diff(start: Column, end: Column) -> Column:
    """Subframes from ``start`` to ``end``.

    Both ends count when the clock did not wrap; across a wrap the plain
    distance is used.
    """
    return F.when(start > end, end + CLOCK_PERIOD - start).otherwise(end - start + 1)


def fix_report_time(time: Column, correction: int = FRAMES) -> Column:
    """Lift a negative report time by one correction step."""
    return F.when(time < 0, time + correction).otherwise(time)


def is_valid_reading(subframe: Column) -> Column:
    return subframe < SUBFRAMES


def last_lcid(lcids: Column) -> Column:
    """Last element of a channel list, NULL for an empty or missing one."""
    return F.when(F.size(lcids) > 0, F.try_element_at(lcids, F.lit(-1)))
