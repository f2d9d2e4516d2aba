"""Projections, filters, routing and partition control."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def run_sql(df: DataFrame, view: str, sql: str) -> DataFrame:
    """Register ``df`` as ``view`` and run SQL text over it."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(sql)


def tokens(df: DataFrame, col: str, pattern: str = "\\s+", name: str = "word") -> DataFrame:
    """One row per piece of ``col``; empty pieces are no words."""
    return df.select(F.explode(F.split(col, pattern)).alias(name)).where(F.col(name) != "")


def keep_parsed(df: DataFrame, predicate: Column, **parsed: Column) -> DataFrame:
    return df.where(predicate).select(*[c.alias(n) for n, c in parsed.items()])


def route_by_threshold(
    df: DataFrame, col: str, bounds: Sequence[float], tags: Sequence[str]
) -> DataFrame:
    """Add ``tag``: the first tag for values above bounds[0], the next for those
    above bounds[1], ... and the last for all others, NaN and null included."""
    value = F.col(col)
    tag = F.when(F.isnan(value), tags[-1])
    for bound, name in zip(bounds, tags):
        tag = tag.when(value > bound, name)
    return df.withColumn("tag", tag.otherwise(tags[-1]))


def tagged(df: DataFrame, tag: str) -> DataFrame:
    """One of the side outputs of a routed frame."""
    return df.where(F.col("tag") == tag).drop("tag")


def sum_of_matches(
    df: DataFrame, predicate: Column, key: Column, default_key: Column, name: str = "key"
) -> DataFrame:
    """Matching rows count 1 under their key, all others 0 under the default key."""
    return (
        df.select(
            F.when(predicate, key).otherwise(default_key).alias(name),
            F.when(predicate, 1).otherwise(0).cast("long").alias("one"),
        )
        .groupBy(name)
        .agg(F.sum("one").alias("cnt"))
    )


def per_partition(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``fn`` maps an iterator of pandas batches, once per partition."""
    return df.mapInPandas(fn, schema)


def with_partition_index(df: DataFrame, name: str = "part") -> DataFrame:
    return df.withColumn(name, F.spark_partition_id())


def keep_partition(df: DataFrame, index: int) -> DataFrame:
    return df.where(F.spark_partition_id() == index)


def sample_rows(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def set_partitions(df: DataFrame, n: int, shuffle: bool, keys: Sequence[str] = ()) -> DataFrame:
    """Fewer partitions by merging neighbours, or ``n`` even (or keyed) ones by a shuffle."""
    return df.repartition(n, *keys) if shuffle else df.coalesce(n)


def union_all(*frames: DataFrame) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of the whole frame (each task keeps its own n first)."""
    return df.orderBy(*order).limit(n)
