"""Streaming forms give the batch answer however the input is cut into batches."""

import os
import random
import shutil

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import aggregates, joins as batch_joins, lateness, ordered, patterns, windows as batch_windows
from tidemark.sources import files
from tidemark.streaming import folds, jobs, joins, keyed, refired, runner, sinks, windows

DDL = "id long, key string, ts timestamp, kind string, v double, arr long"


def history(spark, n=120, seed=5):
    rnd = random.Random(seed)
    rows = [
        (i, rnd.choice("abc"), rnd.randrange(1, 121), rnd.choice(["fail", "fail", "success", "create", "pay"]), float(rnd.randrange(60)))
        for i in range(n)
    ]
    rows.sort(key=lambda r: r[2] + rnd.randrange(8))  # arrival: up to 8 s out of order
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "id long, key string, at long, kind string, v double, arr long")
    return df.withColumn("ts", F.timestamp_seconds("at")).select("id", "key", "ts", "kind", "v", "arr").cache()


def staged(df, path, cuts, marker=True):
    """One parquet file per batch, in order, with the end marker as the last batch."""
    spark, n = df.sparkSession, df.agg(F.max("arr")).first()[0] + 1
    per = -(-n // cuts)
    parts = [df.where(F.floor(F.col("arr") / per) == i) for i in range(cuts)]
    if marker:
        end = spark.range(1).select(
            *[(F.lit(runner.END_OF_TIME).cast("timestamp") if f.name == "ts" else F.lit(None).cast(f.dataType)).alias(f.name) for f in df.schema.fields]
        )
        parts.append(end)
    os.makedirs(path)
    for i, part in enumerate(parts):
        tmp = f"{path}-part{i}"
        part.coalesce(1).write.parquet(tmp)
        name = next(f for f in os.listdir(tmp) if f.endswith(".parquet"))
        shutil.copy(f"{tmp}/{name}", f"{path}/{i:03d}.parquet")
        os.utime(f"{path}/{i:03d}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    return path


def bag(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def us(c):
    return F.unix_micros(c).alias(c)


S = 1_000_000
FOLDS = {
    "jump": (folds.Jump("v", 10.0), ["v"], ("tie", "last", "current"),
             lambda d: ordered.jump_alerts(d, "key", "ts", "id", "v", 10.0).select(F.col("id").alias("tie"), "last", "current")),
    "rise": (folds.Rise("v", 6 * S), ["v"], ("key", "start", "alert_at"),
             lambda d: patterns.rise_alerts(d, "key", "ts", "id", "v", "6 seconds").select("key", us("start"), us("alert_at"))),
    "burst": (folds.Burst("kind", 1, 4 * S), ["kind"], ("key", "first_fail", "last_fail", "fails"),
              lambda d: patterns.login_bursts(d, "key", "ts", "id", "kind", 1, "4 seconds").select("key", us("first_fail"), us("last_fail"), "fails")),
    "run": (folds.AdjacentRun("kind", ["fail", "fail"], 5 * S), ["kind"], ("key", "first_at", "last_at"),
            lambda d: patterns.login_pairs(d, "key", "ts", "id", "kind", "5 seconds").select("key", us("first_at"), us("last_at"))),
    "followed": (folds.FollowedBy("kind", "create", "pay", 15 * S), ["kind"], ("tie", "end_at", "status"),
                 lambda d: patterns.followed_by(d, "key", "ts", "id", "kind", "create", "pay", "15 seconds").select(F.col("id").alias("tie"), us("end_at"), "status")),
    "orders": (folds.OrderOutcome("kind", 10 * S, 10**15), ["kind"], ("tie", "status"),
               lambda d: patterns.order_outcomes(d, "key", "ts", "id", "kind", "10 seconds").select(F.col("id").alias("tie"), "status")),
    "clicks": (folds.ClickFilter(5), [], ("tie", "tag"),
               lambda d: patterns.click_filter(d, ["key"], "ts", "id", 5).select(F.col("id").alias("tie"), "tag")),
    "rolling": (folds.Rolling("v", 2), ["v"], ("tie", "cnt", "mean"),
                lambda d: ordered.rolling_rows(d, ["key"], "ts", "id", "v", 2).select(F.col("id").alias("tie"), "cnt", "mean")),
}


@pytest.mark.parametrize("name", FOLDS)
def test_folds_equal_batch(spark, tmp_path, name):
    fold, cols, out, batch = FOLDS[name]
    df = history(spark)
    if name == "orders":
        df = df.where("kind IN ('create', 'pay')").cache()
    want = bag(batch(df), *out)
    assert want
    path = staged(df, str(tmp_path / "in"), 4)
    stream = files.file_per_batch_stream(spark, path, DDL)
    got = keyed.keyed_fold(stream, ["key"], "ts", "id", cols, fold, "10 seconds")
    assert bag(runner.run_append(got, name).where("key is not null"), *out) == want


def with_nulls(df):
    """Null measures, kinds and keys among the rows."""
    return df.withColumns({
        "v": F.when(F.col("id") % 5 != 0, F.col("v")), "kind": F.when(F.col("id") % 7 != 0, F.col("kind")),
        "key": F.when(F.col("key") != "c", F.col("key")),
    }).cache()


@pytest.mark.parametrize("name", FOLDS)
def test_folds_with_nulls_equal_batch(spark, tmp_path, name):
    fold, cols, out, batch = FOLDS[name]
    df = with_nulls(history(spark, seed=6))
    stream = files.file_per_batch_stream(spark, staged(df, str(tmp_path / "in"), 3), DDL)
    got = keyed.keyed_fold(stream, ["key"], "ts", "id", cols, fold, "10 seconds")
    assert bag(runner.run_append(got, name), *out) == bag(batch(df), *out)


def test_top_two_with_nulls(spark, tmp_path):
    df = with_nulls(history(spark))
    stream = files.file_per_batch_stream(spark, staged(df, str(tmp_path / "in"), 3), DDL)
    log = runner.run_append(keyed.keyed_fold(stream, ["key"], "ts", "id", ["v"], folds.TopTwo("v"), "10 seconds"), "top-two")
    newest = log.groupBy("key", "rank").agg(F.max_by("value", "version").alias("v"))
    assert bag(newest, "key", "rank", "v") == bag(aggregates.top_two(df, ["key"], "v", "id"), "key", "rank", "v")


def test_unpaid_orders_are_out_at_their_deadline(spark, tmp_path):
    """No end marker: the newest row is the last thing that the stream knows."""
    rows = [(0, "a", 0, "create"), (1, "b", 5, "create"), (2, "b", 8, "pay"), (3, "c", 95, "create"), (4, "d", 120, "create"), (5, "a", 121, "pay")]
    df = spark.createDataFrame([(i, k, at, kind, 0.0, i) for i, k, at, kind in rows], "id long, key string, at long, kind string, v double, arr long")
    df = df.withColumn("ts", F.timestamp_seconds(F.col("at") + 1000)).select("id", "key", "ts", "kind", "v", "arr")
    stream = files.file_per_batch_stream(spark, staged(df, str(tmp_path / "in"), 6, marker=False), DDL)
    fold = folds.OrderOutcome("kind", 10 * S, 1000 * S)
    got = runner.run_append(keyed.keyed_fold(stream, ["key"], "ts", "id", ["kind"], fold, "5 seconds", "1 second"), "deadline")
    assert bag(got, "key", "tie", "status") == [("a", 0, "pay timeout"), ("b", 2, "pay successfully"), ("c", 3, "pay timeout")]


def test_delay_is_inclusive(spark, tmp_path):
    """A row exactly ``delay`` behind counts, one further behind does not."""
    at = [100.0, 90.0, 89.9, 105.0]
    rows = [(i, "a", t, "fail", t, i) for i, t in enumerate(at)]
    df = spark.createDataFrame(rows, "id long, key string, at double, kind string, v double, arr long")
    df = df.withColumn("ts", F.timestamp_micros((F.col("at") * 1_000_000).cast("long"))).select("id", "key", "ts", "kind", "v", "arr")
    stream = files.file_per_batch_stream(spark, staged(df, str(tmp_path / "in"), 4), DDL)
    got = keyed.keyed_fold(stream, ["key"], "ts", "id", ["v"], folds.Rolling("v", 0), "10 seconds")
    assert bag(runner.run_append(got, "delay").where("key is not null"), "tie") == [(0,), (1,), (3,)]


def test_changelog_folds_to_the_count(spark, tmp_path):
    path = staged(history(spark), str(tmp_path / "in"), 3)
    log = keyed.keyed_fold(files.file_per_batch_stream(spark, path, DDL), ["key"], "ts", "id", [], folds.CountLog(), "10 seconds")
    log = runner.run_append(log, "log").where("key is not null")
    net = log.groupBy("key", "cnt").agg(F.sum(F.when(F.col("op") == "+", 1).otherwise(-1)).alias("n")).where("n <> 0")
    want = history(spark).groupBy("key").agg(F.count("*").alias("cnt"))
    assert bag(net, "key", "cnt") == bag(want, "key", "cnt")


@pytest.mark.parametrize("cuts", [1, 5])
def test_windows_equal_batch(spark, tmp_path, cuts):
    df = history(spark)
    stream = files.file_per_batch_stream(spark, staged(df, str(tmp_path / "in"), cuts), DDL)
    got = windows.hot_items(stream, "key", "ts", "10 seconds", "20 seconds", "5 seconds", 2, "hot")
    want = batch_windows.hot_items(df, "key", "ts", "20 seconds", "5 seconds", 2)
    cols = ("window_end", "key", "cnt", "rank")
    assert bag(runner.without_marker(got, "window_end"), *cols) == bag(want, *cols)
    again = refired.refired_hot_pages(stream, "key", "ts", "5 seconds", "5 seconds", "20 seconds", "5 seconds", 2, "pages")
    assert bag(runner.without_marker(again, "window_end"), *cols) == bag(want, *cols)


def test_sessions_and_distinct_equal_batch(spark, tmp_path):
    df = history(spark)
    stream = files.file_per_batch_stream(spark, staged(df, str(tmp_path / "in"), 4), DDL)
    got = windows.sessions(stream, ["key"], "ts", "10 seconds", "3 seconds", F.count("*").alias("cnt"))
    want = batch_windows.sessions(df, ["key"], "ts", "3 seconds", F.lit(1))
    cols = ("key", "session_start", "session_end", "cnt")
    assert bag(runner.without_marker(runner.run_append(got, "s"), "session_start"), *cols) == bag(want, *cols)
    got = windows.distinct_per_window(stream, "ts", "10 seconds", "20 seconds", F.col("v"))
    want = df.groupBy(batch_windows.window_end("ts", "20 seconds").alias("window_end")).agg(F.count_distinct("v").alias("cnt"))
    assert bag(runner.without_marker(runner.run_append(got, "d"), "window_start"), "window_end", "cnt") == bag(want, "window_end", "cnt")


def test_stream_join_equals_batch(spark, tmp_path):
    df = history(spark)
    a, b = df.where("kind = 'fail'"), df.where("kind = 'pay'")
    s = lambda kind, sub: files.file_per_batch_stream(spark, staged(df, str(tmp_path / sub), 4), DDL).where(f"kind = '{kind}' OR kind IS NULL")
    got = joins.match_with_timeout(s("fail", "a"), s("pay", "b"), "key", "ts", "2 seconds", "1 second", "10 seconds")
    got = runner.run_append(got, "m").withColumn("at", F.coalesce("l_ts", "r_ts"))
    want = batch_joins.match_with_timeout(a, b, "key", "ts", "2 seconds", "1 second")
    assert bag(runner.without_marker(got, "at"), "l_id", "r_id", "tag") == bag(want, "l_id", "r_id", "tag")


def test_resume_from_checkpoint(spark, tmp_path):
    """Half of the files, a stop, the rest: the same as one run."""
    df = history(spark)
    whole = staged(df, str(tmp_path / "all"), 6)
    parts = str(tmp_path / "parts")
    os.makedirs(parts)
    out = str(tmp_path / "out")

    def run():
        stream = files.file_per_batch_stream(spark, parts, DDL)
        got = keyed.keyed_fold(stream, ["key"], "ts", "id", ["v"], folds.Jump("v", 10.0), "10 seconds")
        return runner.run_append(got, "resume", out=out).where("key is not null")

    for names in (sorted(os.listdir(whole))[:3], sorted(os.listdir(whole))[3:]):
        for name in names:
            shutil.copy2(f"{whole}/{name}", f"{parts}/{name}")
        result = run()
    want = ordered.jump_alerts(df, "key", "ts", "id", "v", 10.0)
    assert bag(result, "tie", "last", "current") == bag(want, "id", "last", "current")


def test_drain_finishes_accepted_input(spark, tmp_path):
    path = staged(history(spark), str(tmp_path / "in"), 4, marker=False)
    seen = []
    query = (
        files.file_per_batch_stream(spark, path, DDL).writeStream
        .foreachBatch(lambda df, i: seen.append(df.count()))
        .option("checkpointLocation", str(tmp_path / "c")).start()
    )
    runner.drain(query)
    assert not query.isActive and sum(seen) == 120


def test_files_are_batches_in_time_order(spark, tmp_path):
    path = staged(history(spark), str(tmp_path / "in"), 5, marker=False)
    order = []
    stream = files.file_per_batch_stream(spark, path, DDL)
    runner.run_batches(stream, "order", lambda df, i, out: order.append((i, df.agg(F.min("arr")).first()[0])))
    assert order == [(i, 24 * i) for i in range(5)]


def test_late_rows_follow_arrival(spark, tmp_path):
    df = history(spark)
    args = ("ts", "arrived", "id", "4 seconds", "1 second", "1 second", "1 second")
    df = df.withColumn("arrived", F.timestamp_seconds("arr"))
    want = lateness.tag_late(df, *args)
    assert want.where("late").count() > 0
    for cuts in (1, 5):
        path = staged(df, str(tmp_path / f"in{cuts}"), cuts, marker=False)
        stream = files.file_per_batch_stream(spark, path, DDL + ", arrived timestamp")
        assert bag(jobs.late_tag_job(stream, *args, "late"), "id", "late") == bag(want, "id", "late")


def test_additive_counts_come_from_state(spark, tmp_path):
    df = history(spark)
    stream = files.file_per_batch_stream(spark, staged(df, str(tmp_path / "in"), 5, marker=False), DDL)
    got = jobs.additive_counts(stream, ["key", "kind"], "sums")
    assert bag(got, "key", "kind", "cnt") == bag(aggregates.count_by(df, ["key", "kind"]), "key", "kind", "cnt")


def test_late_rows_are_a_second_output(spark, tmp_path):
    """What is folded and what comes too late add up to the input, and the fold sees the former only."""
    df = history(spark)
    rows = [r.asDict() for r in df.orderBy("arr").collect()]
    stream = files.file_per_batch_stream(spark, staged(df, str(tmp_path / "in"), 6), DDL)
    both = keyed.keyed_fold(stream, ["key"], "ts", "id", ["v"], folds.Rolling("v", 0), "2 seconds", "1 second", late=True)
    got = runner.run_append(both, "second").where("key is not null").collect()
    passed, late = None, set()
    for i in range(6):
        part = rows[20 * i : 20 * i + 20]
        late |= {r["id"] for r in part if passed is not None and r["ts"].timestamp() < passed}
        passed = max([r["ts"].timestamp() for r in part] + [(passed or 0) + 2]) - 2
    assert late and {r.late_tie for r in got if r.late_tie is not None} == late
    assert sorted([r.late_tie for r in got if r.late_tie is not None] + [r.tie for r in got if r.late_tie is None]) == sorted(r["id"] for r in rows)


def test_waiting_rows_are_written_once(spark, tmp_path):
    """Rows that wait for a long delay stay in the chunk of their batch: no chunk grows."""
    df = history(spark)
    out = str(tmp_path / "out")
    stream = files.file_per_batch_stream(spark, staged(df, str(tmp_path / "in"), 6, marker=False), DDL)
    runner.run_append(keyed.keyed_fold(stream, ["key"], "ts", "id", ["v"], folds.Jump("v", 10.0), "1 hour", "30 seconds"), "wait", out=out)
    chunks = runner.state_of(spark, out, "waiting").select("user_map_key.*", F.size("user_map_value.rows").alias("n")).collect()
    assert sum(c.n for c in chunks) == 120 and max(c.n for c in chunks) <= 20
    assert {c.chunk for c in chunks} == set(range(6))


def test_small_buckets_of_a_batch_share_a_chunk(spark, tmp_path):
    df = history(spark)
    out = str(tmp_path / "out")
    stream = files.file_per_batch_stream(spark, staged(df, str(tmp_path / "in"), 6, marker=False), DDL)
    runner.run_append(keyed.keyed_fold(stream, ["key"], "ts", "id", ["v"], folds.Jump("v", 10.0), "1 hour", "1 second"), "share", out=out)
    chunks = runner.state_of(spark, out, "waiting").select("key.key", "user_map_key.chunk", F.size("user_map_value.rows").alias("n")).collect()
    assert sum(c.n for c in chunks) == 120 and len(chunks) == len({(c.key, c.chunk) for c in chunks})


class Kept:
    """State and timers of one key, in memory."""

    def __init__(self):
        self.held, self.one, self.wakes = {}, None, []

    def getMapState(self, *_):
        return self

    def getValueState(self, *_):
        return Kept()

    def keys(self):
        return iter(list(self.held))

    def getValue(self, key):
        return self.held[key]

    def updateValue(self, key, value):
        assert key not in self.held
        self.held[key] = value

    def removeKey(self, key):
        del self.held[key]

    def exists(self):
        return self.one is not None

    def get(self):
        return self.one

    def update(self, value):
        self.one = value

    def clear(self):
        self.one = None

    def registerTimer(self, at):
        self.wakes.append(at)

    def getLocalProperty(self, _):
        return str(self.batch)


class Passed:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


@pytest.mark.parametrize("bucket", [1, 7, 1000])
def test_a_busy_key_is_held_in_parts(monkeypatch, bucket):
    """Rows become chunks before all rows of the batch are read, and outputs come before all
    chunks are; wherever the watermark stops, rows are folded once and in order."""
    row = T.StructType.fromDDL("_us long, _tie long, v double")
    out = T.StructType.fromDDL("key string, tie long, cnt long, mean double")
    fold = keyed.EventTimeFold(folds.Rolling("v", 0), row.names, row, out, bucket * 1000, False)
    fold.CHUNK, fold.HELD = 8, 20
    state, rnd = Kept(), random.Random(7)
    monkeypatch.setattr(keyed.TaskContext, "get", lambda: state)
    fold.init(state)
    at = [rnd.randrange(100) * 1000 for _ in range(300)]
    state_at_read, got = [], []
    for batch in range(3):
        state.batch = batch

        def rows():
            for i in range(100 * batch, 100 * batch + 100):
                state_at_read.append(sum(len(v[0]) for v in fold.waiting.held.values()))
                yield {"_us": at[i], "_tie": i, "v": 1.0}

        assert list(fold.handleInputRows(("a",), rows(), Passed(0))) == []
    assert all(i - n <= 20 for i, n in enumerate(state_at_read))  # at most HELD rows in memory
    assert min(state.wakes) == (min(at) // (bucket * 1000) + 1) * bucket
    for now in (13, 50, 51, 10**6):
        before = len(fold.waiting.held)
        outputs = fold.handleExpiredTimer(("a",), Passed(now), None)
        first = next(outputs, None)
        assert now < 10**6 or bucket > 100 or first is None or 0 < len(fold.waiting.held) < before
        got += [] if first is None else [first.tie, *(r.tie for r in outputs)]
        assert all((a // (bucket * 1000) + 1) * bucket > now for v in fold.waiting.held.values() for a, *_ in v[0])
    assert got == sorted(range(300), key=lambda i: (at[i], i)) and not fold.waiting.held


def test_days_of_a_user_share_a_page(spark, tmp_path):
    out = str(tmp_path / "out")
    clicks = [(day, usr, ad) for day in (-1, *range(64, 96)) for usr in (1, 2) for ad in (0, 1)]
    for batch in range(2):
        spark.createDataFrame(clicks, "day long, usr long, ad long").write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("day long, usr long, ad long").parquet(str(tmp_path / "in"))
        listed, counters = jobs.blacklist_job(stream, "day", "usr", "ad", 3, "pages", out)
    assert listed.count() == 0 and {tuple(r): 2 for r in clicks} == {(r.day, r.usr, r.ad): r.cnt for r in counters.collect()}
    assert runner.state_of(spark, out, "counters").count() == 2 * 2


def test_a_larger_table_makes_larger_files(spark, tmp_path):
    for n, parts in ((1, 1), (25, 3), (1000, 5), (0, 1)):
        files.in_files(spark.range(n), 10, 5).write.parquet(str(tmp_path / str(n)))
        assert sum(f.endswith(".parquet") for f in os.listdir(tmp_path / str(n))) == parts
        assert spark.read.parquet(str(tmp_path / str(n))).count() == n


def test_a_stream_begins_with_a_history(spark, tmp_path):
    df = history(spark)
    before, after = df.where("ts < timestamp_seconds(60)"), df.where("ts >= timestamp_seconds(60)")
    after = after.withColumn("arr", F.row_number().over(Window.orderBy("arr")) - 1).cache()
    for name, args, batch in (
        ("clicks", (folds.ClickFilter(5), []), lambda d: patterns.click_filter(d, ["key"], "ts", "id", 5).select(F.col("id").alias("tie"), "tag")),
        ("jump", (folds.Jump("v", 10.0), ["v"]), lambda d: ordered.jump_alerts(d, "key", "ts", "id", "v", 10.0).select(F.col("id").alias("tie"), "last", "current")),
    ):
        fold, cols = args
        stream = files.file_per_batch_stream(spark, staged(after, str(tmp_path / name), 3), DDL)
        begin = fold.after(before, ["key"], "ts", "id")
        tail = runner.run_append(keyed.keyed_fold(stream, ["key"], "ts", "id", cols, fold, "10 seconds", initial=begin), name).where("key is not null")
        want = batch(df)
        assert bag(batch(before).union(tail.select(*want.columns)), *want.columns) == bag(want, *want.columns)
    log = folds.CountLog().after(before, ["key"], "ts", "id")
    assert bag(log, "key", "cnt") == bag(aggregates.count_by(before, ["key"]), "key", "cnt")


def test_reports_are_written_again_and_state_is_cleared(spark, tmp_path):
    """Late rows write a report again; after the lateness a window's counts are gone."""
    df = history(spark)
    out = str(tmp_path / "out")
    path = staged(df, str(tmp_path / "in"), 6, marker=False)
    stream = files.file_per_batch_stream(spark, path, DDL)
    reports = refired.report_stream(stream, "key", "ts", "2 seconds", "6 seconds", "20 seconds", "5 seconds", 2, parts=2)
    log = runner.run_append(reports, "again", out=out)
    assert log.where("version > 0").count() > 0 and log.where("late_pane is not null").count() == 0
    newest = df.agg(F.max(F.unix_micros("ts"))).first()[0]
    segments = runner.state_of(spark, out, "counts").select("key.segment").distinct().collect()
    # a segment is over 20 + 6 seconds after its end; the last 20 rows may still have come before the watermark moved
    assert segments and all((r.segment + 1) * 20 * S + 26 * S > newest - 30 * S for r in segments)
    done = str(tmp_path / "done")
    whole = files.file_per_batch_stream(spark, staged(df, str(tmp_path / "closed"), 6), DDL)
    runner.run_append(refired.report_stream(whole, "key", "ts", "2 seconds", "6 seconds", "20 seconds", "5 seconds", 2, parts=2), "closed", out=done)
    assert runner.state_of(spark, done, "counts").count() == 0


def test_rows_too_late_for_every_window_are_told(spark, tmp_path):
    rows = [(0, "a", 100), (1, "b", 101), (2, "a", 500), (3, "b", 100), (4, "b", 499)]
    df = spark.createDataFrame([(i, k, at, "", 0.0, i) for i, k, at in rows], "id long, key string, at long, kind string, v double, arr long")
    df = df.withColumn("ts", F.timestamp_seconds("at")).select("id", "key", "ts", "kind", "v", "arr")
    stream = files.file_per_batch_stream(spark, staged(df, str(tmp_path / "in"), 5), DDL)
    log = runner.run_append(refired.report_stream(stream, "key", "ts", "5 seconds", "5 seconds", "20 seconds", "5 seconds", 2), "told")
    assert bag(log.where("late_pane is not null"), "item", "cnt", "late_pane") == [("b", 1, 100 * S)]
    found = bag(refired.newest_reports(log, "key", 1), "window_end", "key", "cnt", "rank")
    assert len(found) == 9 and {r[1:] for r in found} <= {("a", 1, 1), ("b", 1, 1)}


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    folder = str(tmp_path / "parts")
    good = spark.range(100, numPartitions=5).select("id", F.lit("x").alias("k"))
    sinks.write_parts(good, folder)
    bad = good.withColumn("k", F.when(F.col("id") == 99, F.raise_error(F.lit("no"))).otherwise("y"))
    with pytest.raises(Exception):
        sinks.write_parts(bad, folder)
    assert bag(sinks.read_parts(spark, folder, "id long, k string"), "k") == [("x",)] * 100
    sinks.write_parts(good.limit(3), folder)
    assert sinks.read_parts(spark, folder, "id long, k string").count() == 103


def brute_blacklist(batches, limit):
    listed, counters = set(), {}
    for batch in batches:
        counts = {}
        for key in batch:
            if key[1] not in listed:
                counts[key] = counts.get(key, 0) + 1
        fresh = set()
        for key, n in counts.items():
            if n >= limit:
                fresh.add(key[1])
            elif key in counters:
                counters[key] += n
                if counters[key] >= limit:
                    fresh.add(key[1])
            else:
                counters[key] = n
        listed |= fresh
    return listed, counters


def test_blacklist_job(spark, tmp_path):
    rnd = random.Random(4)
    clicks = [("d", rnd.choice("uvwxyz"), rnd.choice("AB")) for _ in range(200)] + [("d", "hot", "A")] * 30 + [("e", "hot", "A")] * 3
    batches = [clicks[i::6] for i in range(6)]
    ddl = "day string, usr string, ad string, arr long"
    path = str(tmp_path / "in")
    os.makedirs(path)
    for i, rows in enumerate(batches):
        spark.createDataFrame([(*r, i) for r in rows], ddl).coalesce(1).write.parquet(f"{path}-{i}")
        name = next(f for f in os.listdir(f"{path}-{i}") if f.endswith(".parquet"))
        shutil.copy(f"{path}-{i}/{name}", f"{path}/{i}.parquet")
        os.utime(f"{path}/{i}.parquet", (1_700_000_000 + i,) * 2)
    stream = files.file_per_batch_stream(spark, path, ddl)
    listed, counters = jobs.blacklist_job(stream, "day", "usr", "ad", 12, "bl")
    want_listed, want_counters = brute_blacklist(batches, 12)
    assert {r.usr for r in listed.collect()} == want_listed and want_listed
    assert {(r.day, r.usr, r.ad): r.cnt for r in counters.collect()} == want_counters


def test_running_distinct_job(spark, tmp_path):
    path = staged(history(spark), str(tmp_path / "in"), 4, marker=False)
    stream = files.file_per_batch_stream(spark, path, DDL).select(F.col("v").cast("long").alias("v"), "ts", "id")
    got = jobs.running_distinct_job(stream, "v", "ts", "id", "uv")
    n = history(spark).select("v").distinct().count()
    assert sorted(r.uv for r in got.collect()) == list(range(1, n + 1))


def test_update_mode_keeps_the_last_value(spark, tmp_path):
    path = staged(history(spark), str(tmp_path / "in"), 4, marker=False)
    counts = files.file_per_batch_stream(spark, path, DDL).groupBy("key").agg(F.count("*").alias("cnt"))
    assert bag(runner.run_update(counts, "u", ["key"]), "key", "cnt") == bag(aggregates.count_by(history(spark), ["key"]), "key", "cnt")


def test_one_connection_per_partition(spark, tmp_path):
    folder = str(tmp_path / "w")
    os.makedirs(folder)

    def connect():
        import uuid
        return open(f"{folder}/{uuid.uuid4().hex}", "w")

    df = spark.range(100).repartition(4)
    sinks.write_rows(df, connect, lambda f, row: f.write(f"{row.id}\n"))
    lines = [line for f in os.listdir(folder) for line in open(f"{folder}/{f}")]
    assert sorted(map(int, lines)) == list(range(100)) and len(os.listdir(folder)) == 4
