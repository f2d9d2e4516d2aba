"""Event-time windows on finite input."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.aggregates import salted_count, top_n_per_group
from tidemark.plans.halo import floor_micros, micros
from tidemark.plans.panes import sliding


def window_end(ts: str, size: str) -> Column:
    width = micros(size)
    return F.timestamp_micros(floor_micros(F.unix_micros(ts), width) + width)


def tumbling(df: DataFrame, keys: Sequence[str], ts: str, size: str, *aggs: Column) -> DataFrame:
    """Aggregates per key and window, with window_start and window_end."""
    out = df.groupBy(F.window(ts, size).alias("_w"), *keys).agg(*aggs)
    return out.select(
        *keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
        *[c for c in out.columns if c not in ("_w", *keys)],
    )


def total_views(df: DataFrame, ts: str, size: str, row_id: str, salts: int = 64) -> DataFrame:
    """Rows per window: counted by salted key first, then summed per window end."""
    return salted_count(df, [window_end(ts, size).alias("window_end")], row_id, salts)


def hot_items(
    df: DataFrame, item: str, ts: str, size: str, slide: str, n: int
) -> DataFrame:
    """The ``n`` items with most rows in every sliding window."""
    counts = sliding(df, [item], ts, size, slide)
    return top_n_per_group(counts, ["window_end"], [F.desc("cnt"), F.asc(item)], n)


def best_windows(
    df: DataFrame, item: str, ts: str, size: str, slide: str, n: int
) -> DataFrame:
    """The ``n`` sliding windows in which each item had most rows."""
    counts = sliding(df, [item], ts, size, slide)
    return top_n_per_group(counts, [item], [F.desc("cnt"), F.asc("window_end")], n)


def sessions(
    df: DataFrame, keys: Sequence[str], ts: str, gap: str, value: Column
) -> DataFrame:
    """Session windows: rows at most one ``gap`` apart belong together.

    Rows within one gap-wide pane always share a session, so panes stand for
    rows: a key has at most one pane per gap, however many rows it has.
    """
    width = micros(gap)
    at = F.unix_micros(ts)
    panes = (
        df.groupBy(*keys, floor_micros(at, width).alias("_pane"))
        .agg(F.min(at).alias("_lo"), F.max(at).alias("_hi"), F.count(F.lit(1)).alias("_n"),
             F.sum(value).alias("_v"))
        .repartition(*keys)
    )
    w = Window.partitionBy(*keys).orderBy("_pane")
    starts = (F.col("_lo") - F.lag("_hi").over(w) > width) | F.lag("_hi").over(w).isNull()
    numbered = panes.withColumn("_new", starts.cast("long")).withColumn(
        "_session", F.sum("_new").over(w)
    )
    return (
        numbered.groupBy(*keys, "_session")
        .agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.sum("_n").alias("cnt"),
             F.sum("_v").alias("total"))
        .select(*keys, F.timestamp_micros("_lo").alias("session_start"),
                F.timestamp_micros(F.col("_hi") + width).alias("session_end"), "cnt", "total")
    )


def bucketed_series(
    df: DataFrame, ts: str, bucket: str, size: str, slide: str
) -> DataFrame:
    """Per sliding window, the count of each small time bucket inside it."""
    bucket_us = micros(bucket)
    if micros(slide) % bucket_us:
        raise ValueError("the slide must be a multiple of the bucket")
    floor = floor_micros(F.unix_micros(ts), bucket_us)
    counts = df.groupBy(F.timestamp_micros(floor).alias("_bucket")).agg(F.count(F.lit(1)).alias("cnt"))
    return series_of_counts(counts, "_bucket", size, slide)


def series_of_counts(counts: DataFrame, bucket: str, size: str, slide: str) -> DataFrame:
    """``bucketed_series`` of buckets (their start, ``cnt``) that are counted already; a
    bucket lies in one pane, so its count is final before the windows are listed."""
    size_us, slide_us = micros(size), micros(slide)
    pane = floor_micros(F.unix_micros(bucket), slide_us)
    ends = F.sequence(pane + slide_us, pane + size_us, F.lit(slide_us).cast("long"))
    return counts.select(F.explode(ends).alias("_end"), F.col(bucket).alias("bucket"), "cnt").select(
        F.timestamp_micros("_end").alias("window_end"), "bucket", "cnt"
    )


def per_window_function(
    df: DataFrame, keys: Sequence[str], ts: str, size: str, partial, schema: str, *merge: Column
) -> DataFrame:
    """A user function per (key, window), for what built-in aggregates cannot express.

    ``partial`` turns the rows a task has at hand of one (key, window), as pandas,
    into one tuple of the ``schema`` columns; ``merge`` aggregates the partial rows.
    No task ever holds a whole window.
    """
    group = [*keys, "window_end"]
    framed = df.withColumn("window_end", window_end(ts, size))
    parts = T.StructType(
        [framed.schema[g] for g in group] + T.StructType.fromDDL(schema).fields
    )

    def combine(batches):
        for pdf in batches:
            rows = [(*key, *partial(rows)) for key, rows in pdf.groupby(group, dropna=False)]
            yield pd.DataFrame(rows, columns=parts.names)

    return framed.mapInPandas(combine, parts).groupBy(*group).agg(*merge)
