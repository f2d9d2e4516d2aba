"""Windowed aggregates on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregates import top_n_per_group
from tidemark.streaming.runner import run_batches, write_batch


def windowed(
    stream: DataFrame, keys: Sequence[str], ts: str, delay: str, size: str, slide: str | None,
    *aggs: Column,
) -> DataFrame:
    """Aggregates per key and window; keeps the window as ``_w`` for a second step."""
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return stream.withWatermark(ts, delay).groupBy(window.alias("_w"), *keys).agg(*aggs)


def with_bounds(counts: DataFrame) -> DataFrame:
    rest = [c for c in counts.columns if c != "_w"]
    return counts.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *rest
    )


def per_window(counts: DataFrame, size: str, *aggs: Column) -> DataFrame:
    """A second aggregation of ``windowed`` rows, by window only."""
    return counts.groupBy(F.window(F.window_time("_w"), size).alias("_w")).agg(*aggs)


def total_views(stream: DataFrame, ts: str, delay: str, size: str, row_id: str, salts: int = 64) -> DataFrame:
    """Rows per window, counted by salt first."""
    salt = F.pmod(F.xxhash64(row_id), F.lit(salts))
    salted = windowed(
        stream.withColumn("_salt", salt), ["_salt"], ts, delay, size, None, F.count(F.lit(1)).alias("_n")
    )
    return with_bounds(per_window(salted, size, F.sum("_n").alias("cnt")))


def distinct_per_window(stream: DataFrame, ts: str, delay: str, size: str, value: Column) -> DataFrame:
    """Exact distinct values per window: one state row per (window, value)."""
    seen = windowed(
        stream.withColumn("_value", value), ["_value"], ts, delay, size, None, F.count(F.lit(1)).alias("_n")
    )
    return with_bounds(per_window(seen, size, F.count("_value").alias("cnt")))


def sessions(stream: DataFrame, keys: Sequence[str], ts: str, delay: str, gap: str, *aggs: Column) -> DataFrame:
    out = (
        stream.withWatermark(ts, delay)
        .groupBy(F.session_window(ts, gap).alias("_s"), *keys)
        .agg(*aggs)
    )
    return out.select(
        F.col("_s.start").alias("session_start"), F.col("_s.end").alias("session_end"),
        *[c for c in out.columns if c != "_s"],
    )


def hot_items(
    stream: DataFrame, item: str, ts: str, delay: str, size: str, slide: str, n: int, label: str,
    out: str | None = None,
) -> DataFrame:
    """One report per window: its ``n`` items with most rows.

    The watermark closes all items of a window in the same micro-batch, so ranking
    inside the batch is complete and nothing but counts is kept in state.
    """
    counts = with_bounds(
        windowed(stream, [item], ts, delay, size, slide, F.count(F.lit(1)).alias("cnt"))
    ).drop("window_start")

    def report(batch: DataFrame, batch_id: int, out: str) -> None:
        order = [F.desc("cnt"), F.asc(item)]
        write_batch(top_n_per_group(batch, ["window_end"], order, n), batch_id, out)

    out = run_batches(counts, label, report, out=out)
    return _log(stream, out).drop("batch")


def _log(stream: DataFrame, out: str) -> DataFrame:
    return stream.sparkSession.read.option("basePath", f"{out}/rows").parquet(f"{out}/rows")
