"""Overlapping time segments for patterns with a bounded reach.

When a row can only concern rows at most ``back`` before or ``ahead`` after it,
a key may be cut into time segments freely: each segment also receives the rows
of its neighbours that lie within reach (its halo). One shuffle by (key,
segment) then serves any window or join, a hot key is spread over its segments,
and the copies amount to about ``reach / width`` of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH_PER_REACH = 16  # segments this many times the reach: at most 1/16 of rows copied per side


def micros(duration: str) -> int:
    """``'15 minutes'`` → microseconds (fixed-length units only)."""
    amount, unit = duration.split()
    seconds = {
        "millisecond": 0.001, "second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800,
    }[unit.rstrip("s")]
    return int(float(amount) * seconds * 1_000_000)


def default_width(reach_us: int) -> int:
    return max(reach_us, 1) * WIDTH_PER_REACH


def floor_micros(at: Column, width_us: int) -> Column:
    """Largest multiple of ``width_us`` up to ``at``, in whole numbers throughout."""
    return at - F.pmod(at, F.lit(width_us).cast("long"))


def index_of(at: Column, width_us: int) -> Column:
    return F.call_function("div", floor_micros(at, width_us), F.lit(width_us).cast("long"))


def segment(ts: str | Column, width_us: int) -> Column:
    return index_of(F.unix_micros(ts), width_us)


def with_segments(
    df: DataFrame, ts: str, width_us: int, back_us: int = 0, ahead_us: int = 0
) -> DataFrame:
    """Add ``_segment`` and ``_own``; a row appears once with ``_own`` true.

    Segment s holds every row with time in [s*width - back, (s+1)*width + ahead].
    """
    at = F.unix_micros(ts)
    low, high = index_of(at - ahead_us, width_us), index_of(at + back_us, width_us)
    return df.withColumn("_segment", F.explode(F.sequence(low, high))).withColumn(
        "_own", F.col("_segment") == segment(ts, width_us)
    )
