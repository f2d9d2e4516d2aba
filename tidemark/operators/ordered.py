"""Operators that look at neighbouring rows of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.buckets import BUCKET, with_neighbours


def rolling_rows(
    df: DataFrame, keys: Sequence[str], ts: str, tie: str, value: str, preceding: int = 2,
    bucket: str = BUCKET,
) -> DataFrame:
    """Count and mean over the current and the ``preceding`` rows of the key."""
    near = with_neighbours(df, keys, ts, [tie], [value], back=preceding, bucket=bucket)
    window = [F.col(value), *[F.col(f"prev{i}.{value}") for i in range(1, preceding + 1)]]
    n = sum((v.isNotNull().cast("long") for v in window[1:]), window[0].isNotNull().cast("long"))
    total = sum((F.coalesce(v, F.lit(0.0)) for v in window[1:]), F.coalesce(window[0], F.lit(0.0)))
    return near.select(
        *df.columns, n.alias("cnt"), F.when(n > 0, total / n).alias("mean")
    )


def page_flow(
    visits: DataFrame, session: str, ts: str, tie: str, page: str, path: Sequence[int],
    bucket: str = BUCKET,
) -> DataFrame:
    """Conversion of each planned step: moves from → to over all visits of from."""
    near = with_neighbours(
        visits.select(session, ts, tie, page), [session], ts, [tie], [page], back=0, ahead=1, bucket=bucket
    )
    steps = list(zip(path, path[1:]))
    # one aggregate serves both numerator and denominator
    moved = [F.count_if((F.col(page) == a) & (F.col(f"next1.{page}") == b)) for a, b in steps]
    totals = near.where(F.col(page).isin(*path[:-1])).groupBy(F.col(page).alias("from_page")).agg(
        F.count(F.lit(1)).alias("visits"),
        F.array(*[
            F.struct(F.lit(a).alias("start"), F.lit(b).alias("to_page"), n.alias("moves"))
            for (a, b), n in zip(steps, moved)
        ]).alias("_steps"),
    )
    return (
        totals.select("from_page", "visits", F.inline("_steps"))
        .where((F.col("start") == F.col("from_page")) & (F.col("moves") > 0))
        .select(
            "from_page", "to_page", "moves", "visits",
            (F.col("moves") / F.nullif("visits", F.lit(0))).alias("conversion"),
        )
    )


def jump_alerts(
    df: DataFrame, key: str, ts: str, tie: str, value: str, limit: float,
    first_from_zero: bool = False, bucket: str = BUCKET,
) -> DataFrame:
    """Readings that differ from the one before by more than ``limit``.

    The first reading of a key is silent, or compared with 0.0.
    """
    near = with_neighbours(df, [key], ts, [tie], [value], bucket=bucket)
    last = F.col(f"prev1.{value}")
    if first_from_zero:
        last = F.coalesce(last, F.lit(0.0))
    return near.select(key, tie, last.alias("last"), F.col(value).alias("current")).where(
        F.abs(F.col("last") - F.col("current")) > limit
    )
