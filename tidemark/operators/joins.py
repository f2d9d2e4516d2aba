"""Joins by key, by key and time, and against lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.halo import default_width, index_of, micros, with_segments


def lookup(df: DataFrame, dim: DataFrame, on: str, value: str, default: int = 0) -> DataFrame:
    """Left join to a lookup table, ``default`` for a missing key.

    No hint: Spark broadcasts ``dim`` when its measured size allows and shuffles
    both sides otherwise.
    """
    return df.join(dim.select(on, value), on, "left").withColumn(
        value, F.coalesce(value, F.lit(default))
    )


def cogroup_sums(key: str, **sides: tuple[DataFrame, Column]) -> DataFrame:
    """Full-outer sums of one measure per side, in a single aggregation."""
    tagged = None
    for name, (frame, measure) in sides.items():
        part = frame.select(key, F.lit(name).alias("_side"), measure.cast("long").alias("_m"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy(key).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("_side") == n, F.col("_m"))), F.lit(0)).alias(n)
            for n in sides
        ]
    )


def _between(early: str, late: str, lower_us: int, upper_us: int) -> Column:
    gap = F.unix_micros(late) - F.unix_micros(early)
    return gap.between(lower_us, upper_us)


def _qualified(df: DataFrame, on: str, prefix: str) -> DataFrame:
    return df.select(*[F.col(c) if c == on else F.col(c).alias(prefix + c) for c in df.columns])


def interval_join(
    left: DataFrame, right: DataFrame, on: str, ts: str, lower: str, upper: str,
    how: str = "inner",
) -> DataFrame:
    """Pairs with the same ``on`` and right.ts in [left.ts + lower, left.ts + upper].

    Columns come out as l_* and r_*. Joining on (key, time segment) keeps a key
    that holds a large part of the rows spread over many tasks.
    """
    lo, hi = _signed(lower), _signed(upper)
    width = default_width(hi - lo)
    a = with_segments(_qualified(left, on, "l_"), f"l_{ts}", width).drop("_own")
    b = with_segments(
        _qualified(right, on, "r_"), f"r_{ts}", width, back_us=max(-lo, 0), ahead_us=max(hi, 0)
    ).select("*", F.col(on).alias("_r_on"), F.col("_segment").alias("_r_segment")).drop(
        on, "_segment", "_own"
    )
    same = (F.col(on) == F.col("_r_on")) & (F.col("_segment") == F.col("_r_segment"))
    return a.join(b, same & _between(f"l_{ts}", f"r_{ts}", lo, hi), how).drop(
        "_segment", "_r_on", "_r_segment"
    )


def _signed(duration: str) -> int:
    duration = duration.strip()
    return -micros(duration[1:]) if duration.startswith("-") else micros(duration)


def match_with_timeout(
    left: DataFrame, right: DataFrame, on: str, ts: str, wait_left: str, wait_right: str
) -> DataFrame:
    """Every row of both sides, tagged matched / left_only / right_only.

    A left row waits ``wait_left`` for a right row and a right row waits
    ``wait_right`` for a left one, limits included. Rows without a key or a time match nothing.

    One pass: both sides are put together by (key, time segment), each row also into the
    segments that its partners may be in, and one sort serves the list of partners of each
    left row and the sign whether a right row has one.
    """
    low, high = -micros(wait_right), micros(wait_left)
    width = default_width(high - low)
    at = F.unix_micros(ts)
    own = index_of(at, width)

    def side(df: DataFrame, name: str, first: Column, last: Column) -> DataFrame:
        segments = F.sequence(index_of(first, width), index_of(last, width))
        row = F.struct(*[F.col(c).alias(name[1:] + c) for c in df.columns if c != on])
        placed = df.select(
            F.col(on), at.alias("_at"), own.alias("_home"), row.alias(name),
            F.explode(F.coalesce(segments, F.array(F.lit(None).cast("long")))).alias("_segment"),
        )
        return placed.withColumn("_own", F.col("_segment").eqNullSafe(F.col("_home"))).drop("_home")

    both = side(left, "_l_", at + low, at + high).unionByName(
        side(right, "_r_", at - high, at - low), allowMissingColumns=True
    )
    w = Window.partitionBy(on, "_segment").orderBy("_at")
    there = F.col(on).isNotNull() & F.col("_at").isNotNull()
    partners = F.collect_list(F.when(there, F.col("_r_"))).over(w.rangeBetween(low, high))
    met = F.max(F.when(there & F.col("_l_").isNotNull(), True)).over(w.rangeBetween(-high, -low))
    seen = both.withColumns({"_partners": partners, "_met": F.coalesce(met, F.lit(False)) & there}).where("_own")

    def out(l_row: Column, r_row: Column, tag: str) -> Column:
        return F.struct(l_row.alias("_l_"), r_row.alias("_r_"), F.lit(tag).alias("tag"))

    no_left, no_right = (F.lit(None).cast(both.schema[c].dataType) for c in ("_l_", "_r_"))
    pairs = F.transform("_partners", lambda r: out(F.col("_l_"), r, "matched"))
    of_left = F.when(there & (F.size("_partners") > 0), pairs).otherwise(F.array(out(F.col("_l_"), no_right, "left_only")))
    of_right = F.when(~F.col("_met"), F.array(out(no_left, F.col("_r_"), "right_only")))
    rows = seen.select(on, F.inline(F.when(F.col("_l_").isNotNull(), of_left).otherwise(of_right)))
    return rows.select(on, "_l_.*", "_r_.*", "tag")


def latest_pairs(
    left: DataFrame, right: DataFrame, on: str, ts: str, tie: str
) -> DataFrame:
    """Inner join of the last row per key on each side (last value wins)."""

    def latest(df: DataFrame, prefix: str) -> DataFrame:
        rest = [c for c in df.columns if c != on]
        last = F.max_by(F.struct(*rest), F.struct(ts, tie)).alias("_row")
        return df.groupBy(on).agg(last).select(
            on, *[F.col(f"_row.{c}").alias(prefix + c) for c in rest]
        )

    return latest(left, "l_").join(latest(right, "r_"), on)


def without_listed(df: DataFrame, blacklist: DataFrame, key: str) -> DataFrame:
    return df.join(blacklist.select(key), key, "left_anti")


def only_listed(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def month_totals(
    members: DataFrame, orders: DataFrame, on: str, ts: str, money: Column,
    months: Sequence[int] = range(1, 13),
) -> DataFrame:
    """Members with one sum per month and the year's sum, 0 where there is none."""
    month = F.month(ts)
    names = [f"m{m:02d}" for m in months]
    sums = orders.groupBy(on).agg(
        *[F.sum(F.when(month == m, money)).alias(n) for m, n in zip(months, names)],
        F.sum(money).alias("year_total"),
    )
    return members.join(sums, on, "left").fillna(0, subset=[*names, "year_total"])
