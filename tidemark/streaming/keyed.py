"""Keyed event-time folds as a streaming operator.

Rows of a key wait in state until the watermark has passed them and are then
folded in event-time order, so the result does not depend on how the input was
cut into batches. They wait in chunks by time bucket and batch, small buckets of a
batch together: what comes in is written once and not read again until the
watermark has passed the first bucket of its chunk; what is not over then is
written once more, by bucket. What waits is bounded by the watermark delay and one
bucket, what a task holds by a part of a batch and the chunks that overlap.

Rows behind the watermark come too late to be folded. They can be had as a second
output beside the folds'. For a finite history the batch forms in
``tidemark.operators`` split hot keys, which keyed state cannot; a stream can also
begin with what the batch form knows at the end of a history.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from heapq import heappop, heappush

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.plans.halo import micros
from tidemark.streaming.folds import Fold
from tidemark.streaming.runner import END_US

# The column of the watermark lies this far ahead of the event time, and the watermark's delay
# is as much longer: the watermark is the same, but Spark drops no row as too old for it
AHEAD_DAYS = 36_500
BUCKET = "1 minute"


def with_open_watermark(stream: DataFrame, ts: str, delay: str, name: str = "_ahead") -> DataFrame:
    """``stream`` with a watermark ``delay`` behind the newest ``ts``, which no row is dropped for."""
    ahead_ms = AHEAD_DAYS * 86_400_000
    ahead = F.col(ts) + F.make_dt_interval(days=F.lit(AHEAD_DAYS))
    return stream.withColumn(name, ahead).withWatermark(name, f"{ahead_ms + micros(delay) // 1000} milliseconds")


class EventTimeFold(StatefulProcessor):
    """State of a key: what waits, by (first bucket, batch, part of the batch), and what the
    fold remembers."""

    CHUNK = 4_096  # rows up to which small buckets share a chunk
    HELD = 32_768  # rows of a batch that are in memory before they become chunks

    def __init__(
        self, fold: Fold, columns: list[str], row_type: T.StructType, out_type: T.StructType,
        bucket_us: int, late: bool,
    ):
        self.fold, self.columns, self.row_type = fold, columns, row_type
        self.out = Row(*out_type.names)
        self.bucket, self.late = bucket_us, late
        self.state_type = T.StructType.fromDDL(fold.state_ddl)  # parsed by the driver's JVM
        self.width = len(T.StructType.fromDDL(fold.out_ddl))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        chunk = T.StructType().add("bucket", T.LongType()).add("chunk", T.LongType()).add("part", T.LongType())
        self.waiting = handle.getMapState("waiting", chunk, T.StructType().add("rows", T.ArrayType(self.row_type)))
        self.state = handle.getValueState("state", self.state_type)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        state = tuple(initialState[name] for name in self.state_type.names)
        self.state.update(state)
        end = self.fold.deadline(state)
        if end is not None:
            self._wake_at(end + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        fresh: dict[int, list[tuple]] = {}
        held, part, first = 0, 0, None
        for r in rows:
            at = r["_us"]
            if at is None or at < passed:
                if self.late:
                    yield self.out(*key, *[None] * self.width, r["_tie"])
            elif at < END_US:
                fresh.setdefault(at // self.bucket, []).append(tuple(r[c] for c in self.columns))
                held += 1
                if held == self.HELD:
                    first = min(fresh) if first is None else min(first, *fresh)
                    self._hold(fresh, part)
                    fresh, held, part = {}, 0, part + 1
        if fresh:
            first = min(fresh) if first is None else min(first, *fresh)
            self._hold(fresh, part)
        if first is not None:
            self._wake_at((first + 1) * self.bucket)

    def _hold(self, fresh: dict[int, list[tuple]], part: int) -> None:
        """Write rows by bucket; neighbouring small buckets become one chunk, as a chunk costs
        the same however small it is."""
        batch = int(TaskContext.get().getLocalProperty("streaming.sql.batchId") or 0)
        chunks: list[tuple[int, list[tuple]]] = []
        for bucket in sorted(fresh):
            if chunks and len(chunks[-1][1]) + len(fresh[bucket]) <= self.CHUNK:
                chunks[-1][1].extend(fresh[bucket])
            else:
                chunks.append((bucket, fresh[bucket]))
        for bucket, rows in chunks:
            self.waiting.updateValue((bucket, batch, part), (rows,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000  # every row below is here
        over = passed // self.bucket  # the buckets below are over
        chunks = sorted(tuple(k) for k in self.waiting.keys())
        ready = [c for c in chunks if c[0] < over]
        early = [c[0] for c in chunks[len(ready):]]
        before = tuple(self.state.get()) if self.state.exists() else None
        state = self.fold.start() if before is None else before
        rest = [None] * self.late
        rows: list[tuple] = []  # a heap of what is read and lies behind the next chunk's begin
        for i, c in enumerate(ready):
            wait: dict[int, list[tuple]] = {}
            for n, r in enumerate(self.waiting.getValue(c)[0]):
                bucket = r[0] // self.bucket
                if bucket < over:
                    heappush(rows, (r[0], r[1], *c[1:], n, r))
                else:
                    wait.setdefault(bucket, []).append(tuple(r))
            self.waiting.removeKey(c)
            for bucket, held in wait.items():  # by itself from now on, so it is not read again early
                self.waiting.updateValue((bucket, *c[1:]), (held,))
            early += wait
            until = ready[i + 1][0] * self.bucket if i + 1 < len(ready) else passed
            while rows and rows[0][0] < until:
                r = heappop(rows)[-1]
                state, late = self.fold.expire(state, r[0])
                state, made = self.fold.step(state, r[0], r[1], dict(zip(self.columns, r)))
                for values in (*late, *made):
                    yield self.out(*key, *values, *rest)
        # what still waits may lie before the watermark, so time has only come to its bucket
        state, late = self.fold.expire(state, min([passed, *(b * self.bucket for b in early)]) - 1)
        for values in late:
            yield self.out(*key, *values, *rest)
        if state != self.fold.start():
            self.state.update(state)
        elif before is not None:
            self.state.clear()  # a key with nothing to remember has no state
        if early:
            self._wake_at((min(early) + 1) * self.bucket)
        else:
            end = self.fold.deadline(state)
            if end is not None:
                self._wake_at(end + 1)

    def _wake_at(self, at_us: int) -> None:
        """When the watermark, in whole milliseconds, has come to ``at_us``."""
        self.handle.registerTimer(-(-at_us // 1000))

    def close(self) -> None:
        pass


def keyed_fold(
    stream: DataFrame, keys: Sequence[str], ts: str, tie: str, cols: Sequence[str], fold: Fold,
    delay: str, bucket: str = BUCKET, late: bool = False, initial: DataFrame | None = None,
) -> DataFrame:
    """Outputs of ``fold`` with the key columns in front.

    A row may be up to ``delay`` behind the newest one of the batches before. An output
    comes when the watermark has passed the ``bucket`` of the rows that it is made of.
    With ``late``, there is one more column ``late_tie``: rows that came behind the
    watermark, or have no event time, are put out at once with their ``tie`` in it and
    nulls in place of the fold's columns; in the fold's own rows it is null. ``initial``
    holds, for keys that have a past, the keys and the columns of the fold's state.
    """
    keys = list(keys)
    slim = with_open_watermark(
        stream.select(
            *keys, ts, F.unix_micros(ts).alias("_us"), F.col(tie).cast("long").alias("_tie"),
            *[c for c in cols if c not in keys],
        ),
        ts, delay,
    ).drop(ts, "_ahead")  # every cell costs time, and these have done their work
    columns = ["_us", "_tie", *[c for c in cols if c not in keys]]
    row_type = T.StructType([slim.schema[c] for c in columns])
    fields = [slim.schema[k] for k in keys] + T.StructType.fromDDL(fold.out_ddl).fields
    out_type = T.StructType(fields + [T.StructField("late_tie", T.LongType())] * late)
    if initial is not None:
        names = T.StructType.fromDDL(fold.state_ddl).names
        initial = initial.select(*keys, *names).groupBy(*keys)
    return slim.groupBy(*keys).transformWithState(
        statefulProcessor=EventTimeFold(fold, columns, row_type, out_type, micros(bucket), late),
        outputStructType=out_type, outputMode="append", timeMode="eventTime", initialState=initial,
    )
