"""Jobs whose results are kept in state between micro-batches.

A batch reads and writes the state of the keys that it has rows of, whatever came before
it. Rows are combined inside the tasks that read them, so a hot key comes to its state as
a few partial results per task. Tables of results are read from the state itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.aggregates import count_by, running_count
from tidemark.operators.lateness import tag_late
from tidemark.plans.buckets import GLOBAL_BUCKET
from tidemark.session import scratch_dir
from tidemark.streaming.runner import carried, run_append, run_batches, run_state, state_of, write_batch

DAY_MS = 86_400_000


@contextmanager
def held(batch: DataFrame) -> Iterator[DataFrame]:
    """The batch kept while several jobs read it, so that its source is read once."""
    batch = batch.persist()
    try:
        yield batch
    finally:
        batch.unpersist()


def additive_counts(
    stream: DataFrame, keys: Sequence[str], label: str, out: str | None = None, available_now: bool = True,
) -> DataFrame:
    """Counts per key, added up over the batches: insert, or ``cnt = cnt + n``."""
    out = run_state(count_by(stream, keys), label, "update", out, available_now)
    return state_of(stream.sparkSession, out).select("key.*", F.col("value.count").alias("cnt"))


class Blacklist(StatefulProcessor):
    """Of a user: whether listed, and the counters by (day, ad), which may live for ``keep_ms`` only.

    Whole-numbered days share a page of ``PAGE_DAYS``, so that a batch reads and writes a page
    or two and not every counter by itself. A counter with a time to live has a page of its own."""

    PAGE_DAYS = 32

    def __init__(self, limit: int, key_type: T.StructType, keep_ms: int | None):
        self.limit, self.key_type, self.keep_ms = limit, key_type, keep_ms
        self.whole_days = isinstance(key_type[0].dataType, T.IntegralType)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.listed = handle.getValueState("listed", T.StructType().add("listed", T.BooleanType()))
        page_type = self.key_type if self.keep_ms else T.StructType(self.key_type.fields[:1])
        counter = T.StructType([*self.key_type.fields, T.StructField("cnt", T.LongType())])
        self.counters = handle.getMapState("counters", page_type, T.StructType().add("page", T.ArrayType(counter)), self.keep_ms)

    def _page(self, at: tuple) -> tuple:
        if self.keep_ms:
            return at
        return (at[0] // self.PAGE_DAYS if self.whole_days and at[0] is not None else at[0],)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if self.listed.exists():
            return
        fresh: dict[tuple, int] = {}
        for r in rows:
            at = (r["day"], r["ad"])
            fresh[at] = fresh.get(at, 0) + r["n"]
        pages: dict[tuple, list[tuple]] = {}
        for at in fresh:
            pages.setdefault(self._page(at), []).append(at)
        hit = False
        for page, counted in pages.items():
            old = self.counters.getValue(page)
            counters = {tuple(c[:2]): c[2] for c in old[0]} if old else {}
            changed = False
            for at in counted:
                n = fresh[at]
                if n >= self.limit:
                    hit = True
                    continue
                if at in counters:
                    n += counters[at]
                    hit |= n >= self.limit
                counters[at], changed = n, True
            if changed:
                self.counters.updateValue(page, ([(*at, n) for at, n in counters.items()],))
        if hit:
            self.listed.update((True,))
            yield Row("usr")(key[0])

    def close(self) -> None:
        pass


def _counted(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts per key within each Arrow batch, before any shuffle."""
    slim = stream.select(*keys)
    schema = T.StructType([*slim.schema.fields, T.StructField("n", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by(list(keys)).aggregate([([], "count_all")])
            yield from found.rename_columns(schema.names).to_batches()

    return slim.mapInArrow(count, schema)


def blacklist_job(
    clicks: DataFrame, day: str, user: str, ad: str, limit: int, label: str,
    out: str | None = None, available_now: bool = True, keep_days: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(blacklist, counters). Per batch, for users not yet listed:

    * a (day, user, ad) count of ``limit`` or more inside the batch lists the user
      and leaves the counter alone;
    * a smaller count is added to the counter, and if the counter existed already
      and reaches ``limit``, that lists the user too.

    With ``keep_days``, a counter that does not change for so long in processing time is
    forgotten. Spark then always has another batch to run, to see what time it is, so this
    is for a job that goes on and not for one that ends with its input.
    """
    spark = clicks.sparkSession
    named = _counted(clicks.select(F.col(day).alias("day"), F.col(user).alias("usr"), F.col(ad).alias("ad")), ["day", "usr", "ad"])
    key_type = T.StructType([named.schema["day"], named.schema["ad"]])
    listed = named.groupBy("usr").transformWithState(
        statefulProcessor=Blacklist(limit, key_type, keep_days * DAY_MS if keep_days else None),
        outputStructType=T.StructType([named.schema["usr"]]), outputMode="append",
        timeMode="processingTime" if keep_days else "none",
    )
    out = out or scratch_dir(spark, label)
    found = run_append(listed, label, out, available_now).select(F.col("usr").alias(user))
    counters = state_of(spark, out, "counters").select("key.usr", F.explode("user_map_value.page").alias("c")).select(
        F.col("c.day").alias(day), F.col("usr").alias(user), F.col("c.ad").alias(ad), F.col("c.cnt").alias("cnt")
    )
    return found, counters


class FirstRow(StatefulProcessor):
    """The earliest row of a value in the first batch that has it."""

    def __init__(self, out_type: T.StructType):
        self.out = Row(*out_type.names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", T.StructType().add("seen", T.BooleanType()))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if self.seen.exists():
            return
        self.seen.update((True,))
        yield self.out(key[0], *min((r["us"], r["tie"]) for r in rows))

    def close(self) -> None:
        pass


def first_rows(stream: DataFrame, col: str, ts: str, tie: str) -> DataFrame:
    """(value, us, tie) of the first row of each value, once."""
    slim = stream.select(F.col(col).alias("value"), F.unix_micros(ts).alias("us"), F.col(tie).cast("long").alias("tie"))

    schema = slim.schema

    def earliest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.Table.from_batches([batch]).sort_by([("us", "ascending"), ("tie", "ascending")])
            # in that order the first row of a group is its earliest
            found = found.group_by("value", use_threads=False).aggregate([("us", "first"), ("tie", "first")])
            yield from found.rename_columns(schema.names).to_batches()

    few = slim.mapInArrow(earliest, schema)
    return few.groupBy("value").transformWithState(
        statefulProcessor=FirstRow(schema), outputStructType=schema, outputMode="append", timeMode="none",
    )


def running_distinct_job(
    stream: DataFrame, col: str, ts: str, tie: str, label: str, out: str | None = None,
    available_now: bool = True,
) -> DataFrame:
    """One row per new value with the number of distinct values so far; values of
    one batch are ordered by event time, batches by arrival. Null is no value."""
    spark = stream.sparkSession
    fresh = first_rows(stream.where(F.col(col).isNotNull()), col, ts, tie)

    def run(batch: DataFrame, batch_id: int, out: str) -> None:
        before = carried(spark, batch_id, out, "sizes", "n long")
        with held(batch) as rows:
            n = before.n if before else 0
            at = rows.withColumn("at", F.timestamp_micros("us"))
            numbered = running_count(at, [], "at", "tie", bucket=GLOBAL_BUCKET).withColumn("uv", F.col("cnt") + n)
            write_batch(numbered.select(F.col("value").alias(col), F.timestamp_micros("us").alias(ts), F.col("tie").alias(tie), "uv"), batch_id, out)
            write_batch(rows.agg((F.count(F.lit(1)) + n).alias("n")), batch_id, out, "sizes")

    out = run_batches(fresh, label, run, out=out, available_now=available_now)
    return spark.read.option("basePath", f"{out}/rows").parquet(f"{out}/rows").drop("batch")


def late_tag_job(
    stream: DataFrame, ts: str, arrival: str, tie: str, size: str, slide: str, delay: str,
    lateness: str, label: str, out: str | None = None, available_now: bool = True,
) -> DataFrame:
    """``tag_late`` on a stream whose batches follow arrival order: the greatest
    event time of the earlier batches is carried along."""
    spark = stream.sparkSession

    def run(batch: DataFrame, batch_id: int, out: str) -> None:
        top = carried(spark, batch_id, out, "seen", "seen long")
        before = F.lit(top.seen if top else None).cast("long")
        with held(batch) as rows:
            tagged = tag_late(rows, ts, arrival, tie, size, slide, delay, lateness, seen_before=before)
            write_batch(tagged, batch_id, out)
            seen = rows.agg(F.greatest(F.max(F.unix_micros(ts)), before).alias("seen"))
            write_batch(seen, batch_id, out, "seen")

    out = run_batches(stream, label, run, out=out, available_now=available_now)
    return spark.read.option("basePath", f"{out}/rows").parquet(f"{out}/rows").drop("batch")
