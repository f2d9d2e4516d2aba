"""Late rows of a stream, found on its recorded arrival order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.halo import floor_micros, micros
from tidemark.plans.buckets import GLOBAL_BUCKET, running


def closed_before(at: Column, seen: Column, size: str, slide: str, delay: str, lateness: str) -> Column:
    """Whether the last window of a row at ``at`` microseconds had been closed when ``seen`` was
    the greatest event time so far; false before the first row."""
    last_end = floor_micros(at, micros(slide)) + micros(size)
    return F.coalesce(last_end + micros(lateness) <= seen - micros(delay), F.lit(False))


def with_seen(df: DataFrame, ts: str, arrival: str, tie: str, name: str = "seen", bucket: str = GLOBAL_BUCKET) -> DataFrame:
    """``df`` with the greatest event time of earlier arrivals, as a source would stamp it."""
    at = F.unix_micros(ts)
    return running(df, [], arrival, [tie], {name: at}, "max", include_current=False, bucket=bucket)


def tag_late(
    df: DataFrame, ts: str, arrival: str, tie: str, size: str, slide: str, delay: str,
    lateness: str, bucket: str = GLOBAL_BUCKET, seen_before: Column | None = None,
) -> DataFrame:
    """Add ``late``: the last window of the row had been closed when it arrived.

    The watermark before a row is the greatest event time of earlier arrivals
    less ``delay``; a window closes when it passes its end plus ``lateness``.
    ``seen_before`` is the greatest event time of rows that came before ``df``.
    """
    seen = with_seen(df, ts, arrival, tie, "_seen", bucket)
    greatest = F.col("_seen") if seen_before is None else F.greatest("_seen", seen_before)
    late = closed_before(F.unix_micros(ts), greatest, size, slide, delay, lateness)
    return seen.withColumn("late", late).drop("_seen")
