"""Keys are cut into time buckets: results must not depend on where the cuts fall."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.aggregates import running_distinct
from tidemark.operators.lateness import tag_late
from tidemark.plans.buckets import running, with_neighbours
from tidemark.plans.timers import NONE, step, timer_windows


def skewed(spark, n=600, seed=1, tick=1):
    """A third of the rows belong to one key and a third of those to one instant."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{rnd.randrange(40)}"
        at = 50 if key == "hot" and rnd.random() < 0.33 else rnd.randrange(400)
        rows.append((i, key, at * tick, rnd.randrange(100), rnd.choice("oooc")))
    rows.append((n, None, 7, 1, "o"))
    df = spark.createDataFrame(rows, "id long, key string, at long, v long, kind string")
    return df.withColumn("ts", F.timestamp_seconds("at")).repartition(7), rows


def collected(df, *cols):
    return sorted(df.select(*cols).collect(), key=str)


@pytest.mark.parametrize("bucket", ["1 second", "7 seconds", "1 minute", "9 weeks"])
def test_neighbours_equal_plain_window(spark, bucket):
    df, _ = skewed(spark)
    w = Window.partitionBy("key").orderBy("ts", "id")
    for back, ahead in [(1, 0), (2, 0), (1, 1), (3, 2)]:
        got = with_neighbours(df, ["key"], "ts", ["id"], ["v", "id"], back, ahead, bucket)
        want = df.withColumns(
            {f"prev{i}": F.lag(F.struct("v", "id"), i).over(w) for i in range(1, back + 1)}
            | {f"next{i}": F.lead(F.struct("v", "id"), i).over(w) for i in range(1, ahead + 1)}
        )
        cols = want.columns
        assert sorted(got.columns) == sorted(cols)
        assert collected(got, *cols) == collected(want, *cols)


@pytest.mark.parametrize("bucket", ["1 second", "7 seconds", "1 minute", "9 weeks"])
@pytest.mark.parametrize("keys", [["key"], []])
def test_running_equals_plain_window(spark, bucket, keys):
    df, _ = skewed(spark)
    w = Window.partitionBy(*keys).orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    got = running(df, keys, "ts", ["id"], {"s": F.col("v")}, bucket=bucket)
    assert collected(got, "id", "s") == collected(df.withColumn("s", F.sum("v").over(w)), "id", "s")
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    got = running(df, keys, "ts", ["id"], {"m": F.col("v")}, "max", include_current=False, bucket=bucket)
    assert collected(got, "id", "m") == collected(df.withColumn("m", F.max("v").over(past)), "id", "m")


def test_plans_are_lazy(spark):
    """Nothing is counted or collected while a plan is built."""
    df, _ = skewed(spark)
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    with_neighbours(df, ["key"], "ts", ["id"], ["v"], 2, 1)
    running(df, ["key"], "ts", ["id"], {"s": F.col("v")})
    timer_windows(df, ["key"], "ts", "id", F.col("kind") == "o", F.col("kind") == "c", 1_000_000)
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_a_key_is_spread_over_its_buckets(spark):
    rows = spark.range(3000).select("id", F.lit("hot").alias("key"), F.timestamp_seconds(F.col("id") * 60).alias("ts"))
    got = with_neighbours(rows, ["key"], "ts", ["id"], ["id"])
    w = Window.partitionBy("key").orderBy("ts", "id")
    assert collected(got, "id", "prev1") == collected(rows.withColumn("prev1", F.lag(F.struct("id")).over(w)), "id", "prev1")
    assert "_bucket" in got._jdf.queryExecution().executedPlan().toString()


def brute_timers(rows, span):
    """One event after the other, straight from the definition."""
    out, state, last = {}, {}, {}
    for i, key, at, _v, kind in sorted(rows, key=lambda r: (r[2], r[0])):
        at *= 1_000_000
        new, owner = step(state.get(key, NONE), at, i, kind == "o", span)
        state[key] = new
        if owner != NONE:
            n, end, cancelled = out.get((key, *owner), (0, 0, False))
            if kind == "o":
                out[(key, *owner)] = (n + 1, at, cancelled)
            else:
                out[(key, *owner)] = (n, end, True)
    return sorted(((k[0], k[1], *v) for k, v in out.items()), key=str)


@pytest.mark.parametrize("span, batch", [(1, 7), (3, 1), (3, 40), (30, 7), (30, 10_000), (1000, 7)])
def test_timers_equal_sequential_fold(spark, span, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    for seed in (1,):
        df, rows = skewed(spark, n=400, seed=seed)
        got = timer_windows(
            df, ["key"], "ts", "id", F.col("kind") == "o", F.col("kind") == "c", span * 1_000_000, "30 seconds"
        )
        mine = sorted(
            ((r.key, r.s, r.opens, r.e, r.cancelled) for r in got.select(
                "key", F.unix_micros("start").alias("s"), "opens", F.unix_micros("last_open").alias("e"), "cancelled"
            ).collect()), key=str,
        )
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert mine == brute_timers(rows, span * 1_000_000)


@pytest.mark.parametrize("bucket", ["1 second", "1 minute", "9 weeks"])
def test_running_distinct(spark, bucket):
    df, rows = skewed(spark)
    got = running_distinct(df.where("key is not null"), "key", "ts", "id", bucket=bucket)
    first = {}
    for i, key, at, *_ in sorted(rows, key=lambda r: (r[2], r[0])):
        if key is not None and key not in first:
            first[key] = len(first) + 1
    assert {r.key: r.uv for r in got.collect()} == first


@pytest.mark.parametrize("bucket", ["1 second", "1 minute", "9 weeks"])
def test_late_rows(spark, bucket):
    rnd = random.Random(3)
    rows = [(i, rnd.randrange(3000), i) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, at long, arr long").select(
        "id", F.timestamp_seconds("at").alias("ts"), F.timestamp_seconds("arr").alias("arrival")
    )
    got = tag_late(df, "ts", "arrival", "id", "10 minutes", "5 seconds", "1 minute", "1 minute", bucket)
    seen, late = None, {}
    for i, at, _ in rows:
        late[i] = seen is not None and at // 5 * 5 + 600 + 60 <= seen - 60
        seen = at if seen is None else max(seen, at)
    assert {r.id: r.late for r in got.collect()} == late and any(late.values())
