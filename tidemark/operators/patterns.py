"""Event patterns per key, on finite input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.aggregates import top_n_per_group
from tidemark.plans.buckets import BUCKET, with_neighbours
from tidemark.plans.halo import default_width, index_of, micros, with_segments
from tidemark.plans.timers import timer_windows


def rise_alerts(
    df: DataFrame, key: str, ts: str, tie: str, value: str, interval: str,
    bucket: str = BUCKET,
) -> DataFrame:
    """Keys whose value rose and did not fall for ``interval`` after the rise.

    The reading before the first is 0.0. Equal readings change nothing.
    """
    near = with_neighbours(df.select(key, ts, tie, value), [key], ts, [tie], [value], bucket=bucket)
    last = F.coalesce(F.col(f"prev1.{value}"), F.lit(0.0))
    moves = near.select(
        key, ts, tie, (F.col(value) > last).alias("_up"), (F.col(value) < last).alias("_down")
    )
    timers = timer_windows(moves, [key], ts, tie, F.col("_up"), F.col("_down"), micros(interval), bucket)
    return timers.where(~F.col("cancelled")).select(key, "start", F.col("deadline").alias("alert_at"))


def login_bursts(
    df: DataFrame, user: str, ts: str, tie: str, kind: str, limit: int, span: str,
    bucket: str = BUCKET,
) -> DataFrame:
    """More than ``limit`` failures within ``span`` of the first and nothing else
    between them; any other event of the user ends the burst."""
    timers = timer_windows(
        df, [user], ts, tie, F.col(kind) == "fail", F.col(kind) != "fail", micros(span), bucket
    )
    return timers.where(~F.col("cancelled") & (F.col("opens") > limit)).select(
        user, F.col("start").alias("first_fail"), F.col("last_open").alias("last_fail"),
        F.col("opens").alias("fails"),
    )


def _segmented(df: DataFrame, ts: str, back: str | None = None, ahead: str | None = None) -> DataFrame:
    back_us, ahead_us = micros(back) if back else 0, micros(ahead) if ahead else 0
    return with_segments(df, ts, default_width(max(back_us, ahead_us)), back_us, ahead_us)


def adjacent_run(
    df: DataFrame, key: str, ts: str, tie: str, kind: str, steps: Sequence[str], within: str
) -> DataFrame:
    """Strictly adjacent events of the kinds ``steps``, first to last in less than
    ``within``. Overlapping matches all count."""
    w = Window.partitionBy(key, "_segment").orderBy(ts, tie)
    n = len(steps)
    parts = _segmented(df, ts, back=within).withColumns(
        {f"_kind{i}": F.lag(kind, i).over(w) for i in range(1, n)}
        | {"_first": F.lag(ts, n - 1).over(w)}
    )
    matched = F.col(kind) == steps[-1]
    for i in range(1, n):
        matched = matched & (F.col(f"_kind{i}") == steps[n - 1 - i])
    near = F.unix_micros(ts) - F.unix_micros("_first") < micros(within)
    return parts.where(F.col("_own") & matched & near).select(
        key, F.col("_first").alias("first_at"), F.col(ts).alias("last_at")
    )


def login_pairs(
    df: DataFrame, user: str, ts: str, tie: str, kind: str, span: str
) -> DataFrame:
    """A failure right after a failure, less than ``span`` later."""
    return adjacent_run(df, user, ts, tie, kind, ["fail", "fail"], span)


def followed_by(
    df: DataFrame, key: str, ts: str, tie: str, kind: str, begin: str, end: str, within: str
) -> DataFrame:
    """Every ``begin`` with the first ``end`` after it in less than ``within``, or
    status ``timeout``; events between the two do not matter."""
    reach = micros(within)
    # descending order turns "first after this row" into a running minimum
    after = (
        Window.partitionBy(key, "_segment")
        .orderBy(F.desc(ts), F.desc(tie))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ends = F.when(F.col(kind) == end, F.col(ts))
    found = (
        _segmented(df.where(F.col(kind).isin(begin, end)), ts, ahead=within)
        .withColumn("_end", F.min(ends).over(after))
        .where(F.col("_own") & (F.col(kind) == begin))
    )
    in_time = F.unix_micros("_end") - F.unix_micros(ts) < reach
    return found.select(
        key, tie, F.col(ts).alias("begin_at"),
        F.when(in_time, F.col("_end")).alias("end_at"),
        F.when(in_time, "pay success").otherwise("timeout").alias("status"),
    )


def order_outcomes(
    df: DataFrame, order: str, ts: str, tie: str, kind: str, within: str, keep: str = "60 days",
    bucket: str = BUCKET,
) -> DataFrame:
    """What became of every create and pay:

    * ``pay successfully``        a pay right after a create, in time
    * ``paid but timed out``      a pay right after a create, too late
    * ``paid without create``     a pay whose last event was no open create
    * ``pay timeout``             a create that is not paid in time, whatever comes later

    A create is remembered for ``keep`` beyond its time; a later pay has none. Events of
    other kinds are nothing.
    """
    used = df.where(F.col(kind).isin("create", "pay")).select(order, ts, tie, kind)
    near = with_neighbours(
        used, [order], ts, [tie], [kind, ts], back=1, ahead=1,
        bucket=bucket,
    )
    waited = F.unix_micros(ts) - F.unix_micros(F.col(f"prev1.{ts}"))
    known = (F.col(f"prev1.{kind}") == "create") & (waited < micros(within) + micros(keep))
    opened = F.coalesce(known, F.lit(False))
    wait = F.unix_micros(F.col(f"next1.{ts}")) - F.unix_micros(ts)
    unpaid = ~F.coalesce((F.col(f"next1.{kind}") == "pay") & (wait < micros(within)), F.lit(False))
    status = (
        F.when((F.col(kind) == "pay") & ~opened, "paid without create")
        .when((F.col(kind) == "pay") & (waited < micros(within)), "pay successfully")
        .when(F.col(kind) == "pay", "paid but timed out")
        .when((F.col(kind) == "create") & unpaid, "pay timeout")
    )
    return near.select(order, tie, status.alias("status")).where(F.col("status").isNotNull())


def click_filter(
    df: DataFrame, keys: Sequence[str], ts: str, tie: str, limit: int
) -> DataFrame:
    """The first ``limit`` clicks of each UTC day pass, the next raises the day's
    one warning; the rest are dropped. ``tag`` is ``pass`` or ``warning``."""
    day = index_of(F.unix_micros(ts), micros("1 day"))  # whatever the session's zone
    dated = df.withColumn("_day", day)
    first = top_n_per_group(
        dated, [*keys, "_day"], [F.asc(ts), F.asc(tie)], limit + 1, rank="_rank"
    )
    tag = F.when(F.col("_rank") <= limit, "pass").otherwise("warning")
    return first.withColumn("tag", tag).drop("_rank", "_day")
