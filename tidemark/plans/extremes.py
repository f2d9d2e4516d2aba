"""Greatest or least value of sliding windows, without an inverse and without copies per window.

A maximum cannot take a value back, so a running sum over change points does not work. Time is
cut into blocks of one window's length instead: a window is the end of one block and the
beginning of the next, so its extreme is that of a running extreme from the left in one
block and of one from the right in the other. Every pane asks for the two windows at which it
comes in and goes out, each with one question to each of the two blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.buckets import with_neighbours
from tidemark.plans.halo import floor_micros, index_of, micros


def sliding_extreme(
    df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str, value: Column, how: str = "max",
    name: str = "highest", bucket: str = "1 day",
) -> DataFrame:
    """(keys, first_end, next_end, ``name``): windows ending in [first_end, next_end) have this
    extreme of ``value``. Nulls count for nothing, and windows without a value are not listed.

    Rows are combined to slide-wide panes; each pane is then four small rows whatever
    size / slide is, shuffled by (key, block), so a hot key is spread over its blocks.
    """
    size_us, slide_us = micros(size), micros(slide)
    if size_us % slide_us:
        raise ValueError(f"window size {size} must be a multiple of the slide {slide}")
    fold = {"max": F.max, "min": F.min}[how]
    keys = list(keys)
    pane = floor_micros(F.unix_micros(ts), slide_us).alias("_at")
    panes = df.select(*keys, pane, value.alias("_v")).where("_v IS NOT NULL").groupBy(*keys, "_at").agg(fold("_v").alias("_v"))
    ends = F.explode(F.array(F.col("_at") + slide_us, F.col("_at") + size_us + slide_us)).alias("_end")
    # a pane that goes out as another comes in asks the same question
    asked = panes.select(*keys, ends).distinct()
    sides = F.explode(F.array(F.lit(True), F.lit(False))).alias("_forward")
    # from the left up to the window's last pane, or from the right down to its first
    place = F.when(F.col("_forward"), F.col("_end") - slide_us).otherwise(F.col("_end") - size_us)
    questions = asked.select(*keys, "_end", sides).select(*keys, "_end", "_forward", place.alias("_at"))
    every = panes.select(*keys, "_at", "_v", sides).unionByName(questions, allowMissingColumns=True)
    every = every.withColumn("_block", index_of(F.col("_at"), size_us))
    # one order for both directions; equal places are taken in together, and so before their question
    step = F.when(F.col("_forward"), F.col("_at")).otherwise(-F.col("_at"))
    run = Window.partitionBy(*keys, "_block", "_forward").orderBy("_step").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    found = every.withColumn("_step", step).withColumn("_best", fold("_v").over(run)).where("_end IS NOT NULL")
    answers = found.groupBy(*keys, "_end").agg(fold("_best").alias(name))
    steps = answers.withColumn("first_end", F.timestamp_micros("_end"))
    near = with_neighbours(steps, keys, "first_end", [], ["first_end"], back=0, ahead=1, bucket=bucket)
    return near.where(F.col(name).isNotNull()).select(*keys, "first_end", F.col("next1.first_end").alias("next_end"), name)
