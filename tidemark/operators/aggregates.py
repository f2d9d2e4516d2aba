"""Counts, folds, rankings and distinct counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import bitmap_offset, integer_mean
from tidemark.operators.rows import tokens
from tidemark.plans.buckets import BUCKET, GLOBAL_BUCKET, running


def count_by(df: DataFrame, keys: Sequence[str], name: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def word_count(df: DataFrame, col: str, pattern: str = "\\s+") -> DataFrame:
    return count_by(tokens(df, col, pattern), ["word"])


def top_n_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group. Every task cuts its part of a group to
    ``n`` rows before the shuffle, so a huge group is small when it is gathered."""
    w = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)
    return ranked.withColumn(rank, F.col(rank).cast("long"))


def two_rule_fold(
    df: DataFrame, keys: Sequence[str], part: str, value: str, name: str = "total"
) -> DataFrame:
    """Maximum inside each part, sum of the maxima over the parts."""
    inner = df.groupBy(*keys, part).agg(F.max(value).alias("_max"))
    return inner.groupBy(*keys).agg(F.sum("_max").alias(name))


def mean_by_key(df: DataFrame, keys: Sequence[str], value: Column, name: str = "mean") -> DataFrame:
    return df.groupBy(*keys).agg(integer_mean(value).alias(name))


def category_counts(
    df: DataFrame, click: str, order_list: str, pay_list: str, exclusive: bool = False,
    missing: Sequence[str] = ("-1", "null"),
) -> DataFrame:
    """Clicks, orders and pays per category; the lists are comma-joined ids.

    Additive: each of the three columns counts on its own. Exclusive: a row
    counts as a click if it has one, else as orders, else as pays.
    """

    kinds = {"click": click, "order": order_list, "pay": pay_list}

    def ids(kind: str, col: str) -> Column:
        present = F.col(col).isNotNull() & ~F.col(col).isin(*missing)
        return F.when(present, F.struct(F.lit(kind).alias("kind"), F.col(col).alias("ids")))

    lists = [ids(kind, col) for kind, col in kinds.items()]
    chosen = F.array(F.coalesce(*lists)) if exclusive else F.array(*lists)
    return (
        df.select(F.explode(chosen).alias("l"))
        .where("l IS NOT NULL")
        .select("l.kind", F.explode(F.split("l.ids", ",")).alias("category_id"))
        .groupBy("category_id")
        .agg(*[F.count_if(F.col("kind") == k).alias(f"{k}s") for k in kinds])
    )


def category_ranking(counts: DataFrame, n: int = 10) -> DataFrame:
    order = [F.desc("clicks"), F.desc("orders"), F.desc("pays"), F.asc("category_id")]
    return counts.orderBy(*order).limit(n)


def top_sessions_of_top_categories(
    visits: DataFrame, n_categories: int = 10, n_sessions: int = 10
) -> DataFrame:
    """The sessions with most clicks inside each of the leading categories."""
    top = category_ranking(
        category_counts(
            visits, "click_category_id", "order_category_ids", "pay_category_ids", exclusive=True
        ),
        n_categories,
    ).select(F.col("category_id").alias("click_category_id"))
    clicks = visits.where(F.col("click_category_id").isNotNull())
    # at most n_categories rows, so the broadcast is bounded by a parameter
    kept = clicks.join(F.broadcast(top), "click_category_id", "left_semi")
    counts = count_by(kept, ["click_category_id", "session_id"])
    return top_n_per_group(
        counts, ["click_category_id"], [F.desc("cnt"), F.asc("session_id")], n_sessions
    )


def running_count(
    df: DataFrame, keys: Sequence[str], ts: str, tie: str, name: str = "cnt",
    bucket: str = BUCKET,
) -> DataFrame:
    """The count per key as it stands after each row."""
    return running(df, keys, ts, [tie], {name: F.lit(1).cast("long")}, bucket=bucket)


def running_sum(
    df: DataFrame, keys: Sequence[str], ts: str, tie: str, value: Column, name: str = "total",
    bucket: str = BUCKET,
) -> DataFrame:
    return running(df, keys, ts, [tie], {name: value}, bucket=bucket)


def running_distinct(
    df: DataFrame, col: str, ts: str, tie: str, name: str = "uv", bucket: str = GLOBAL_BUCKET
) -> DataFrame:
    """One row per new value, with the number of distinct values seen so far."""
    first = df.groupBy(col).agg(F.min(F.struct(ts, tie)).alias("_first"))
    return running(
        first.select(col, "_first.*"), [], ts, [tie], {name: F.lit(1).cast("long")}, bucket=bucket
    )


def observed_sum(df: DataFrame, value: Column, name: str = "total") -> tuple[DataFrame, Observation]:
    """A side metric: readable from the observation once an action has run."""
    seen = Observation(f"sum of {name}")
    return df.observe(seen, F.sum(value).alias(name)), seen


def count_map(counts: DataFrame, key: str, name: str = "cnt", maps: int = 1024) -> DataFrame:
    """Counts packed into ``maps`` maps, one per row; choose their number by that of the keys."""
    return (
        counts.groupBy(F.pmod(F.xxhash64(key), F.lit(maps)).alias("shard"))
        .agg(F.map_from_entries(F.collect_list(F.struct(key, name))).alias("counts"))
    )


def conditional_counts(df: DataFrame, key: str, flags: dict[str, Column]) -> DataFrame:
    """One 0/1 sum per flag."""
    return df.groupBy(key).agg(
        *[F.sum(F.when(cond, 1).otherwise(0)).alias(n) for n, cond in flags.items()]
    )


def bitmap_distinct(
    df: DataFrame, window_end: Column, col: Column, bits: int = 1 << 29, seed: int = 61
) -> DataFrame:
    """Distinct bitmap positions per window: values sharing a position count once."""
    return df.groupBy(window_end.alias("window_end")).agg(
        F.count_distinct(bitmap_offset(col, seed, bits)).alias("cnt")
    )


def approximate_distinct(
    df: DataFrame, window_end: Column, col: Column, error: float = 0.02
) -> DataFrame:
    """Distinct values per window within a relative standard ``error``: a sketch of fixed
    size per window instead of all its values."""
    return df.groupBy(window_end.alias("window_end")).agg(
        F.approx_count_distinct(col, error).alias("cnt")
    )


def salted_count(
    df: DataFrame, keys: Sequence[str | Column], row_id: str, salts: int = 64, name: str = "cnt"
) -> DataFrame:
    """Two-stage count with a salt from the row id, the same on every attempt."""
    salt = F.pmod(F.xxhash64(row_id), F.lit(salts)).alias("_salt")
    part = df.groupBy(*keys, salt).agg(F.count(F.lit(1)).alias("_n"))
    plain = [c for c in part.columns if c not in ("_salt", "_n")]
    return part.groupBy(*plain).agg(F.sum("_n").alias(name))


def top_two(df: DataFrame, keys: Sequence[str], value: str, tie: str, sentinel: float | None = None) -> DataFrame:
    """Highest and second highest value per key as ranks 1 and 2; equal values
    both count. A key with one row gets ``sentinel`` (null) as its second."""
    best = top_n_per_group(df, keys, [F.desc(value), F.asc(tie)], 2)
    pair = best.groupBy(*keys).agg(
        F.max(F.when(F.col("rank") == 1, F.col(value))).alias("_1"),
        F.max(F.when(F.col("rank") == 2, F.col(value))).alias("_2"),
    )
    second = F.col("_2") if sentinel is None else F.coalesce("_2", F.lit(sentinel))
    rows = F.array(
        F.struct(F.lit(1).alias("rank"), F.col("_1").alias(value)),
        F.struct(F.lit(2).alias("rank"), second.alias(value)),
    )
    return pair.select(*keys, F.inline(rows))
