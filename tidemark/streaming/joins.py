"""Joins of two streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sides(left: DataFrame, right: DataFrame, on: str, ts: str, delay: str):
    a = left.select(*[F.col(c).alias(f"l_{c}") for c in left.columns]).withWatermark(f"l_{ts}", delay)
    b = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns]).withWatermark(f"r_{ts}", delay)
    return a, b, F.col(f"l_{on}") == F.col(f"r_{on}")


def _within(ts: str, before: str, after: str) -> Column:
    early = F.col(f"r_{ts}") >= F.col(f"l_{ts}") - F.expr(f"INTERVAL {before}")
    return early & (F.col(f"r_{ts}") <= F.col(f"l_{ts}") + F.expr(f"INTERVAL {after}"))


def interval_join(
    left: DataFrame, right: DataFrame, on: str, ts: str, before: str, after: str, delay: str,
    how: str = "inner",
) -> DataFrame:
    """right.ts in [left.ts - before, left.ts + after]; both limits included."""
    a, b, same = _sides(left, right, on, ts, delay)
    return a.join(b, same & _within(ts, before, after), how)


def match_with_timeout(
    left: DataFrame, right: DataFrame, on: str, ts: str, wait_left: str, wait_right: str, delay: str
) -> DataFrame:
    """Full outer interval join; an unmatched row comes out once its wait is over."""
    out = interval_join(left, right, on, ts, wait_right, wait_left, delay, "full_outer")
    tag = (
        F.when(F.col(f"r_{ts}").isNull(), "left_only")
        .when(F.col(f"l_{ts}").isNull(), "right_only")
        .otherwise("matched")
    )
    return out.withColumn("tag", tag)


def batch_join(stream: DataFrame, left: Column, right: Column, on: str, cols: list[str]):
    """Per micro-batch: equi-join of two selections of the same batch."""

    def pairs(batch: DataFrame, batch_id: int) -> DataFrame:
        a = batch.where(left).select(on, *[F.col(c).alias(f"l_{c}") for c in cols])
        b = batch.where(right).select(on, *[F.col(c).alias(f"r_{c}") for c in cols])
        return a.join(b, on).withColumn("batch_id", F.lit(batch_id).cast("long"))

    return pairs
