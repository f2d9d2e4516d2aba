"""Timer windows: an *open* event starts a timer unless one is running, a
*cancel* event stops it, otherwise it expires ``span`` after its start.

Each start depends on the one before, so a key is a sequential fold, but no timer is
running after a cancel, nor when the last open is more than ``span`` ago. These places cut
a key into runs that do not depend on each other. A run is folded from timer start to timer
start, over numpy arrays of many runs at once; what stands between two starts is counted,
not visited. ``step`` is the fold for one event, as the streaming processors use it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.buckets import BUCKET, running, with_neighbours

NONE = (-1, -1)  # no timer is running


def step(
    state: tuple[int, int], at: int, tie: int, opens: bool, span: int
) -> tuple[tuple[int, int], tuple[int, int]]:
    """(new state, the timer this event belongs to). The deadline is inclusive."""
    if state != NONE and at > state[0] + span:
        state = NONE
    if opens:
        if state == NONE:
            state = (at, tie)
        return state, state
    return NONE, state


def _timers(batches: Iterator[pd.DataFrame], keys: list[str], span: int) -> Iterator[pd.DataFrame]:
    """One row per timer of the runs in rows sorted by (run, time).

    A timer that reaches the end of a batch goes on into the next one as its first row,
    so memory does not depend on the length of a run.
    """
    held = None
    for pdf in batches:
        if pdf.empty:
            continue
        extra = 0
        if held is not None:
            head = pdf.iloc[:1].copy()
            for k in keys:
                head[k] = pd.Series([held[k]], index=head.index, dtype=head[k].dtype)
            head = head.assign(_us=held["_start"], _tie=held["_start_tie"], _opens=True, _first=True)
            pdf = pd.concat([head, pdf], ignore_index=True)
            extra = held["opens"] - 1
        at, opens = pdf["_us"].to_numpy(np.int64), pdf["_opens"].to_numpy(bool)
        first = pdf["_first"].to_numpy(bool)
        # one time axis for all runs, with more than a span between two of them
        axis = np.cumsum(np.concatenate(([0], np.where(first[1:], span + 1, at[1:] - at[:-1]))))
        past = np.searchsorted(axis, axis + span, side="right")
        n, starts, level = len(at), [], np.flatnonzero(first)
        while len(level):
            starts.append(level)
            level = past[level]
            level = level[level < n]
            level = level[~first[level] & opens[level]]
        begin = np.sort(np.concatenate(starts))
        end = past[begin]
        opened = np.concatenate(([0], np.cumsum(opens)))
        last_open = np.maximum.accumulate(np.where(opens, np.arange(n), 0))
        found = pdf.loc[begin, keys].reset_index(drop=True)
        found["_start"], found["_start_tie"] = at[begin], pdf["_tie"].to_numpy(np.int64)[begin]
        found["_last"] = at[last_open[end - 1]]
        found["opens"] = opened[end] - opened[begin]
        found["cancelled"] = ~opens[end - 1]
        if extra:
            found.loc[0, "opens"] += extra
            if found.loc[0, "_last"] == held["_start"]:
                found.loc[0, "_last"] = held["_last"]
        held = None
        if end[-1] == n and not found["cancelled"].iloc[-1]:
            held = found.iloc[-1].to_dict()
            found = found.iloc[:-1]
        yield found
    if held is not None:
        yield pd.DataFrame([held]).astype(found.dtypes)


def timer_windows(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    opens: Column,
    cancels: Column,
    span_us: int,
    bucket: str = BUCKET,
) -> DataFrame:
    """(keys, start, last_open, opens, cancelled, deadline), one row per timer."""
    keys = list(keys)
    used = df.where(opens | cancels).select(
        *keys, ts, F.unix_micros(ts).alias("_us"), F.col(tie).cast("long").alias("_tie"),
        opens.alias("_opens"),
    )
    near = with_neighbours(used, keys, ts, ["_tie"], ["_opens", "_us"], bucket=bucket)
    follows = F.col("prev1._opens") & (F.col("_us") - F.col("prev1._us") <= span_us)
    marked = near.withColumn("_first", ~F.coalesce(follows, F.lit(False))).drop("prev1")
    marked = marked.where("_opens OR NOT _first")  # other cancels stop nothing
    runs = running(marked, keys, ts, ["_tie"], {"_run": F.col("_first").cast("long")}, bucket=bucket)
    ordered = runs.select(*keys, "_run", "_us", "_tie", "_opens", "_first")
    ordered = ordered.repartition(*keys, "_run").sortWithinPartitions(*keys, "_run", "_us", "_tie")
    timer_type = T.StructType(
        [used.schema[k] for k in keys]
        + [T.StructField(n, T.LongType()) for n in ("_start", "_start_tie", "_last", "opens")]
        + [T.StructField("cancelled", T.BooleanType())]
    )
    timers = ordered.mapInPandas(lambda it: _timers(it, keys, span_us), timer_type)
    return timers.select(
        *keys,
        F.timestamp_micros("_start").alias("start"),
        F.timestamp_micros("_last").alias("last_open"),
        "opens",
        "cancelled",
        F.timestamp_micros(F.col("_start") + span_us).alias("deadline"),
    )
