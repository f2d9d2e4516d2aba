"""Distinct counts from parts that can be combined: bitmaps and sketches per pane.

A pane's part is built once from its rows, with partial results on the map side, and every
window is made of its panes' parts, so a window never sees its rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.halo import floor_micros, micros

LOG_REGISTERS = 12


def _ends(size: str, slide: str) -> tuple[int, Column]:
    size_us, slide_us = micros(size), micros(slide)
    if size_us % slide_us:
        raise ValueError(f"window size {size} must be a multiple of the slide {slide}")
    first = F.col("_pane") + slide_us
    return slide_us, F.sequence(first, F.col("_pane") + size_us, F.lit(slide_us).cast("long"))


def bitmap_panes(df: DataFrame, keys: Sequence[str], ts: str, slide: str, position: Column) -> DataFrame:
    """(keys, _pane, _bucket, _bits): the positions seen in each pane as bitmaps of 4 kB, one for
    each 32,768 positions of which one was seen."""
    pane = floor_micros(F.unix_micros(ts), micros(slide))
    rows = df.select(*keys, pane.alias("_pane"), position.cast("long").alias("_at")).where("_at IS NOT NULL")
    return rows.groupBy(*keys, "_pane", F.bitmap_bucket_number("_at").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("_bits")
    )


def sliding_bitmap_distinct(
    df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str, position: Column, name: str = "cnt"
) -> DataFrame:
    """(keys, window_end, cnt): exact distinct ``position`` values (whole numbers from 0) per
    window. A window's bitmap is the union of its panes'; nulls are not counted."""
    _, ends = _ends(size, slide)
    parts = bitmap_panes(df, keys, ts, slide, position).select(*keys, F.explode(ends).alias("_end"), "_bucket", "_bits")
    whole = parts.groupBy(*keys, "_end", "_bucket").agg(F.bitmap_count(F.bitmap_or_agg("_bits")).alias("_n"))
    counts = whole.groupBy(*keys, "_end").agg(F.sum("_n").alias(name))
    return counts.select(*keys, F.timestamp_micros("_end").alias("window_end"), name)


def sliding_sketch_distinct(
    df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str, value: Column, log_registers: int = LOG_REGISTERS,
    name: str = "cnt",
) -> DataFrame:
    """(keys, window_end, cnt): distinct values per window, estimated from sketches of a fixed
    size (2^log_registers registers, a standard error of about 0.83 / sqrt of that); nulls
    are not counted."""
    slide_us, ends = _ends(size, slide)
    pane = floor_micros(F.unix_micros(ts), slide_us)
    rows = df.select(*keys, pane.alias("_pane"), value.alias("_v")).where("_v IS NOT NULL")
    parts = rows.groupBy(*keys, "_pane").agg(F.hll_sketch_agg("_v", log_registers).alias("_sketch"))
    windows = parts.select(*keys, F.explode(ends).alias("_end"), "_sketch").groupBy(*keys, "_end")
    counts = windows.agg(F.hll_sketch_estimate(F.hll_union_agg("_sketch")).alias(name))
    return counts.select(*keys, F.timestamp_micros("_end").alias("window_end"), name)
