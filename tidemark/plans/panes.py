"""Sliding windows from slide-wide panes.

The built-in ``window()`` copies a row once per window it falls into: 720 times
for 1 hour / 5 seconds. Here rows are first aggregated into panes as wide as the
slide (partial aggregation, so a hot key costs one row per pane and task), and
only panes are combined:

* ``sliding``        every window, by exploding panes
* ``change_points``  the count as a step function of the window end; its size
                     does not depend on size / slide
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.halo import floor_micros, index_of, micros


def pane_counts(
    df: DataFrame, keys: Sequence[str], ts: str, slide: str, amount: Column | None = None
) -> DataFrame:
    """Rows (or the sum of ``amount``) per key and slide-wide pane."""
    width = micros(slide)
    pane = floor_micros(F.unix_micros(ts), width)
    n = F.count(F.lit(1)) if amount is None else F.sum(amount)
    return df.groupBy(*keys, pane.alias("_pane")).agg(n.alias("_n"))


def _check(size: str, slide: str) -> tuple[int, int]:
    size_us, slide_us = micros(size), micros(slide)
    if size_us % slide_us:
        raise ValueError(f"window size {size} must be a multiple of the slide {slide}")
    return size_us, slide_us


def sliding(
    df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str,
    amount: Column | None = None, name: str = "cnt",
) -> DataFrame:
    """(keys, window_end, cnt) for every window that holds a row."""
    size_us, slide_us = _check(size, slide)
    first = F.col("_pane") + slide_us
    ends = F.sequence(first, F.col("_pane") + size_us, F.lit(slide_us).cast("long"))
    return (
        pane_counts(df, keys, ts, slide, amount)
        .select(*keys, F.explode(ends).alias("_end"), "_n")
        .groupBy(*keys, "_end")
        .agg(F.sum("_n").alias(name))
        .select(*keys, F.timestamp_micros("_end").alias("window_end"), name)
    )


def change_points(
    df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str,
    amount: Column | None = None, name: str = "cnt", bucket: str = "1 day",
) -> DataFrame:
    """(keys, first_end, next_end, cnt): windows ending in [first_end, next_end) count ``cnt``.

    A pane p adds its count to windows ending from p + slide on and takes it
    away again from p + size + slide on. The running sum of a key is cut into time
    buckets: what the earlier ones add up to, and where the next one begins, is a row
    in front of each bucket.
    """
    size_us, slide_us = _check(size, slide)
    changes = F.array(
        F.struct((F.col("_pane") + slide_us).alias("at"), F.col("_n").alias("d")),
        F.struct((F.col("_pane") + size_us + slide_us).alias("at"), (-F.col("_n")).alias("d")),
    )
    steps = (
        pane_counts(df, keys, ts, slide, amount)
        .select(*keys, F.inline(changes))
        .groupBy(*keys, index_of(F.col("at"), micros(bucket)).alias("_bucket"), "at")
        .agg(F.sum("d").alias("d"))
        .where("d <> 0")
    )
    key_buckets = Window.partitionBy(*keys).orderBy("_bucket")
    carried = steps.groupBy(*keys, "_bucket").agg(F.sum("d").alias("d"), F.min("at").alias("_low")).select(
        *keys, "_bucket", F.lit(None).cast("long").alias("at"),
        F.sum("d").over(key_buckets.rowsBetween(Window.unboundedPreceding, -1)).alias("d"),
        F.lead("_low").over(key_buckets).alias("_next"),
    )
    rows = Window.partitionBy(*keys, "_bucket").orderBy(F.asc_nulls_first("at"))
    following = F.coalesce(F.lead("at").over(rows), F.first("_next").over(rows))
    return (
        steps.unionByName(carried, allowMissingColumns=True)
        .select(
            *keys, "at",
            F.timestamp_micros("at").alias("first_end"),
            F.timestamp_micros(following).alias("next_end"),
            F.sum("d").over(rows).alias(name),
        )
        .where(F.col("at").isNotNull() & (F.col(name) != 0))
        .drop("at")
    )


def expand_change_points(steps: DataFrame, slide: str) -> DataFrame:
    """Back to one row per window, for a consumer that wants them all."""
    slide_us = micros(slide)
    ends = F.sequence(
        F.unix_micros("first_end"), F.unix_micros("next_end") - slide_us, F.lit(slide_us).cast("long")
    )
    rest = [c for c in steps.columns if c not in ("first_end", "next_end")]
    return steps.select(*rest, F.explode(ends).alias("_end")).select(
        *rest, F.timestamp_micros("_end").alias("window_end")
    )
