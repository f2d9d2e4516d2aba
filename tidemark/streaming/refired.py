"""Top-N reports per sliding window that are written again when late rows change them.

State is cut by time: a key is a segment of one window's length and a part of the
items, and holds the counts of the slide-wide panes that the windows ending in that
segment are made of. Rows are counted into panes inside the tasks that read them, so
only counts are shuffled, each to the one or two segments that its windows end in.
A timer at a window's end reports it, rows that come later report it again, and the
segment's last timer, when no row in time can come any more, clears all of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.aggregates import top_n_per_group
from tidemark.operators.lateness import closed_before
from tidemark.plans.halo import floor_micros, micros
from tidemark.streaming.keyed import with_open_watermark
from tidemark.streaming.runner import END_US, run_append

PARTS = 8


class WindowReports(StatefulProcessor):
    """(segment, part): counts by (pane, item), the end of the newest reported window and the
    number of reports."""

    def __init__(self, item_type: T.DataType, out_type: T.StructType, size: int, slide: int, lateness: int, n: int):
        self.item_type, self.out = item_type, Row(*out_type.names)
        self.size, self.slide, self.lateness, self.n = size, slide, lateness, n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        pane = T.StructType().add("pane", T.LongType()).add("item", self.item_type)
        self.counts = handle.getMapState("counts", pane, T.StructType().add("n", T.LongType()))
        self.marks = handle.getValueState("marks", T.StructType().add("reported", T.LongType()).add("version", T.LongType()))

    def _first(self, key) -> int:
        """Start of the first pane that a window of this segment may have."""
        return (key[0] - 1) * self.size

    def _ends(self, key, pane: int) -> range:
        """The segment's windows that have this pane."""
        low = max(pane + self.slide, key[0] * self.size + self.slide)
        return range(low, min(pane + self.size, (key[0] + 1) * self.size) + 1, self.slide)

    def _marks(self) -> tuple[int, int]:
        return tuple(self.marks.get()) if self.marks.exists() else (-END_US, 0)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        fresh: dict[tuple, int] = {}
        for r in rows:
            if r["pane"] >= END_US:
                continue
            if r["pane"] + self.size + self.lateness <= passed:
                # no window of this pane is open; told once, by the segment of its first window
                if r["pane"] // self.size == key[0]:
                    yield self.out(key[1], None, None, None, r["item"], r["n"], r["pane"])
                continue
            at = (r["pane"], r["item"])
            fresh[at] = fresh.get(at, 0) + r["n"]
        if not fresh:
            return
        for at, n in fresh.items():
            old = self.counts.getValue(at)
            self.counts.updateValue(at, (n + (old[0] if old else 0),))
        reported, version = self._marks()
        touched = sorted({e for pane, _ in fresh for e in self._ends(key, pane)})
        again = [e for e in touched if e <= reported]
        if again:
            yield from self._report(key, again, version, self._held())
            self.marks.update((reported, version + 1))
        if len(again) < len(touched):
            self._wake_at(touched[len(again)])
        self._wake_at(self._last(key))

    def _last(self, key) -> int:
        """From here on every row of the segment's panes is too late."""
        return (key[0] + 1) * self.size + self.size + self.lateness

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        if not self.counts.exists():
            return
        reported, version = self._marks()
        held = self._held()
        panes = sorted({k[0] for k, _ in held})
        ends = sorted({e for pane in panes for e in self._ends(key, pane) if e > reported})
        now = [e for e in ends if e <= passed]
        if now:
            yield from self._report(key, now, version, held)
        if passed >= self._last(key):
            self.counts.clear()
            self.marks.clear()
            return
        if now:
            self.marks.update((now[-1], version + 1))
        if len(now) < len(ends):
            self._wake_at(ends[len(now)])

    def _held(self) -> list[tuple[tuple, int]]:
        return [(tuple(k), v[0]) for k, v in self.counts.iterator()]

    def _report(self, key, ends: list[int], version: int, held: list[tuple[tuple, int]]) -> Iterator[Row]:
        """The first ``n`` items of each window: most rows first, then by item."""
        items = sorted({k[1] for k, _ in held}, key=lambda x: (x is not None, "" if x is None else x))
        at = {x: i for i, x in enumerate(items)}
        first, wide = self._first(key), self.size // self.slide
        total = np.zeros((len(items), 2 * wide + 1), np.int64)
        for (pane, item), n in held:
            total[at[item], (pane - first) // self.slide + 1] = n
        total = total.cumsum(axis=1)
        for end in ends:
            until = (end - first) // self.slide
            counts = total[:, until] - total[:, until - wide]
            for rank, i in enumerate(np.argsort(-counts, kind="stable")[: self.n].tolist(), 1):
                if counts[i]:
                    yield self.out(key[1], end, version, rank, items[i], int(counts[i]), None)

    def _wake_at(self, at_us: int) -> None:
        self.handle.registerTimer(-(-at_us // 1000))

    def close(self) -> None:
        pass


def _pane_counts(stream: DataFrame, item: str, ts: str, slide_us: int) -> DataFrame:
    """(item, pane, n, newest): counts within each Arrow batch, before any shuffle."""
    us = F.unix_micros(ts)
    rows = stream.where(us.isNotNull()).select(F.col(item).alias("item"), floor_micros(us, slide_us).alias("pane"), us.alias("us"))
    schema = T.StructType([rows.schema["item"], *T.StructType.fromDDL("pane long, n long, newest long").fields])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by(["item", "pane"]).aggregate([("us", "count"), ("us", "max")])
            yield from found.rename_columns(schema.names).to_batches()

    return rows.mapInArrow(count, schema).withColumn("at", F.timestamp_micros("newest"))


def report_stream(
    stream: DataFrame, item: str, ts: str, delay: str, lateness: str, size: str, slide: str, n: int,
    parts: int = PARTS, seen: Column | None = None,
) -> DataFrame:
    """Reports as (part, end, version, rank, item, cnt, late_pane), ``end`` in microseconds.

    A window of a part of the items is reported when the watermark, ``delay`` behind the newest
    row, comes to its end, and again with each batch that changes it. Rows whose windows
    are all ``lateness`` behind the watermark are not counted but told by themselves: their
    pane and number, without an end. ``seen`` is the greatest event time of earlier
    arrivals where the source stamps its rows with it; rows that are late by it are left out too.
    """
    size_us, slide_us, lateness_us = micros(size), micros(slide), micros(lateness)
    if size_us % slide_us:
        raise ValueError(f"window size {size} must be a multiple of the slide {slide}")
    if seen is not None:
        stream = stream.where(~closed_before(F.unix_micros(ts), seen, size, slide, delay, lateness))
    counted = with_open_watermark(_pane_counts(stream, item, ts, slide_us), "at", delay)
    segments = F.expr(f"sequence(floor(pane / {size_us}), floor((pane + {size_us - 1}) / {size_us}))")
    keyed = counted.select(
        F.explode(segments).alias("segment"), F.pmod(F.xxhash64("item"), F.lit(parts)).alias("part"),
        "item", "pane", "n", "_ahead",
    )
    kind = counted.schema["item"].dataType
    out = T.StructType.fromDDL("part long, end long, version long, rank int")
    out = out.add("item", kind).add("cnt", T.LongType()).add("late_pane", T.LongType())
    return keyed.groupBy("segment", "part").transformWithState(
        statefulProcessor=WindowReports(kind, out, size_us, slide_us, lateness_us, n),
        outputStructType=out, outputMode="append", timeMode="eventTime",
    )


def newest_reports(log: DataFrame, item: str, n: int) -> DataFrame:
    """(window_end, item, cnt, rank): the last report of every window, over all parts."""
    last = log.where("end IS NOT NULL").groupBy("end", "part", "rank").agg(F.max_by(F.struct("item", "cnt"), "version").alias("r"))
    rows = last.select(F.timestamp_micros("end").alias("window_end"), F.col("r.item").alias(item), "r.cnt")
    return top_n_per_group(rows, ["window_end"], [F.desc("cnt"), F.asc(item)], n)


def refired_hot_pages(
    stream: DataFrame, item: str, ts: str, delay: str, lateness: str, size: str, slide: str, n: int,
    label: str, out: str | None = None, parts: int = PARTS, seen: Column | None = None,
) -> DataFrame:
    """``report_stream`` run over what is available; the last report per window is kept."""
    reports = report_stream(stream, item, ts, delay, lateness, size, slide, n, parts, seen)
    return newest_reports(run_append(reports, label, out), item, n)
