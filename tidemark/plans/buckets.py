"""Ordered per-key work in two levels, so that a hot key is spread over time.

``lag`` or a running sum needs the rows of a key in order, and a plain window sends all of
them to one task. Here every key is cut into time buckets, at any size of the data and
without looking at it: a bucket's rows are ordered by one task, and what a bucket needs to
know of the earlier ones (their last rows, or their total) is found among a few rows per
bucket and put in front of it. So what one task orders is a bucket's rows, and after that a
key's buckets; neither is a key's rows. Everything is lazy.

Only rows of one key inside one bucket stay together; choose the bucket by the rate of the
busiest key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.halo import micros, segment

BUCKET = "1 hour"
GLOBAL_BUCKET = "1 minute"  # where all rows have one key


def with_bucket(df: DataFrame, ts: str, bucket: str) -> DataFrame:
    return df.withColumns({"_bucket": segment(ts, micros(bucket)), "_own": F.lit(True)})


def _lent(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, forward: bool
) -> DataFrame:
    """The last ``n`` rows before each bucket (or the first ``n`` after it), as rows of it.

    Of each bucket only its ``n`` outer rows can be lent, and Spark cuts to these before
    the shuffle. A row is lent to each of the following buckets that fewer than ``n``
    others lie in front of.
    """
    inner = [F.desc(c) for c in order] if forward else [F.asc(c) for c in order]
    outer = Window.partitionBy(*keys, "_bucket").orderBy(*inner)
    edge = rows.withColumn("_edge", F.row_number().over(outer)).where(F.col("_edge") <= n).drop("_edge")
    across = Window.partitionBy(*keys).orderBy(*order)
    move = F.lead if forward else F.lag
    near = [F.col("_bucket"), *(move("_bucket", i).over(across) for i in range(1, n + 1))]
    placed = edge.withColumn("_near", F.array(*near))
    targets = F.filter(F.array_distinct("_near"), lambda b: b.isNotNull() & (b != F.col("_bucket")))
    return (
        placed.withColumn("_targets", targets)
        .where(F.size("_targets") > 0)
        .withColumn("_bucket", F.explode("_targets"))
        .withColumn("_own", F.lit(False))
        .drop("_near", "_targets")
    )


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    ties: Sequence[str],
    cols: Sequence[str],
    back: int = 1,
    ahead: int = 0,
    bucket: str = BUCKET,
) -> DataFrame:
    """Add ``prev1..prevN`` and ``next1..nextM``: structs of ``cols``, null where there is no row."""
    order = [ts, *ties]
    rows = with_bucket(df, ts, bucket)
    slim = rows.select(*dict.fromkeys([*keys, *order, *cols, "_bucket", "_own"]))
    every = rows
    if back:
        every = every.unionByName(_lent(slim, keys, order, back, True), allowMissingColumns=True)
    if ahead:
        every = every.unionByName(_lent(slim, keys, order, ahead, False), allowMissingColumns=True)
    w = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    near = F.struct(*cols)
    found = {f"prev{i}": F.lag(near, i).over(w) for i in range(1, back + 1)}
    found |= {f"next{i}": F.lead(near, i).over(w) for i in range(1, ahead + 1)}
    return every.withColumns(found).where("_own").drop("_bucket", "_own")


def running(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    ties: Sequence[str],
    values: dict[str, Column],
    how: str = "sum",
    include_current: bool = True,
    bucket: str = BUCKET,
) -> DataFrame:
    """Add running ``sum`` or ``max`` columns in (ts, ties) order per key.

    A bucket is summed up with partial aggregation; the sum of the earlier buckets is a row
    in front of its own.
    """
    fold = {"sum": F.sum, "max": F.max}[how]
    rows = with_bucket(df, ts, bucket).withColumns({f"_v_{n}": value for n, value in values.items()})
    totals = rows.groupBy(*keys, "_bucket").agg(*[fold(f"_v_{n}").alias(f"_v_{n}") for n in values])
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = F.row_number().over(Window.partitionBy(*keys).orderBy("_bucket")) == 1
    before = totals.select(
        *keys, "_bucket", F.lit(False).alias("_own"), first.alias("_first"),
        *[fold(f"_v_{n}").over(earlier).alias(f"_v_{n}") for n in values],
    )
    every = rows.unionByName(before.where("NOT _first").drop("_first"), allowMissingColumns=True)
    end = Window.currentRow if include_current else -1
    w = Window.partitionBy(*keys, "_bucket").orderBy("_own", ts, *ties).rowsBetween(Window.unboundedPreceding, end)
    found = every.withColumns({n: fold(f"_v_{n}").over(w) for n in values})
    return found.where("_own").drop("_bucket", "_own", *[f"_v_{n}" for n in values])
