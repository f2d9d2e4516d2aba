"""Streaming forms, run over the events table as a stream until it is used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.basics import INTERVAL_SQL, LATEST_SQL, TIMEOUT_SQL
from tidemark.catalog.registry import query, us
from tidemark.catalog.sequences import MIXED, MIXED_DAYS
from tidemark.catalog.timed import web_requests
from tidemark.functions.scalar import bitmap_offset
from tidemark.operators import lateness, ordered, patterns, windows as batch_windows
from tidemark.operators.aggregates import top_n_per_group
from tidemark.plans import panes
from tidemark.session import scratch_dir
from tidemark.sources import files, tables
from tidemark.sources.replay import replay_stream
from tidemark.streaming import folds, jobs, joins, keyed, refired, runner, sinks, windows

HOUR = 3600 * 1000000
DAY = 24 * HOUR
EVENT_DDL = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"



def closed(spark, sf, view=None, keep=None):
    """A view of the event stream with the end marker behind it."""
    s = tables.event_stream(spark, sf)
    s = view(s) if view else s
    return runner.with_end_marker(spark, s.where(keep) if keep else s, "ts")


def replay(spark, sf, batches: int = 5):
    """The events table in ``batches`` micro-batches by event id, and the step."""
    n = tables.table(spark, sf, "events").agg(F.max("event_id")).first()[0] + 1
    step = -(-n // batches)
    stream = replay_stream(spark, f"{sf}/events.parquet", EVENT_DDL, "event_id", n, step)
    return tables.with_instant(stream)


def by_turns(df, at, turns: int):
    """Parts of ``df`` by equal stretches of the whole number ``at``."""
    low, high = df.agg(F.min(at), F.max(at)).first()
    turn = F.call_function("div", (at - low) * turns, F.lit(high - low + 1)) if low is not None else F.lit(0)
    return [df.where(turn == i) for i in range(turns)]


def event_turns(spark, sf, label, run, batches: int = 5):
    """The events handed on in ``batches`` parts by event id; ``run`` gets them with their instant."""
    given = tables.table(spark, sf, "events")
    step = -(-(given.agg(F.max("event_id")).first()[0] + 1) // batches)
    parts = [given.where(F.call_function("div", F.col("event_id"), F.lit(step)) == i) for i in range(batches)]
    return runner.fed(spark, parts, given.schema, label, lambda s, out: run(tables.with_instant(s), out))


# batch number of a row in the SQL twin of a five-batch replay
BATCH = "event_id // ((SELECT (MAX(event_id) + 5) // 5 FROM events))"


def seconds(df, *cols):
    return df.withColumns({c: F.unix_seconds(c) for c in cols})


@query("a16_replay_source", "SELECT event_id, user_id, event_type, value, us FROM ev")
def _(spark, sf):
    rows = replay(spark, sf).select("event_id", "user_id", "event_type", "value", us("ts", "us"))
    return runner.run_append(rows, "replay", available_now=False)


@query("b10_per_batch_transform", f"SELECT event_id, CAST({BATCH} AS BIGINT) AS batch_id FROM events")
def _(spark, sf):
    def tag(batch, batch_id, out):
        runner.write_batch(batch.withColumn("batch_id", F.lit(batch_id).cast("long")), batch_id, out)

    out = event_turns(spark, sf, "per-batch", lambda s, out: runner.run_batches(s.select("event_id"), "per-batch", tag, out=out))
    return spark.read.option("basePath", f"{out}/rows").parquet(f"{out}/rows").drop("batch")


@query("d1_word_count_stream", """
    SELECT word, COUNT(*) AS cnt FROM (SELECT unnest(string_split(event_type || ' ' || props, ' ')) AS word FROM events)
    GROUP BY word""")
def _(spark, sf):
    s = tables.event_stream(spark, sf)
    words = s.select(F.explode(F.split(F.concat_ws(" ", "event_type", "props"), " ")).alias("word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    return runner.run_update(counts, "words", ["word"])


@query("d20_counts_stream", "SELECT user_id % 4 AS channel, behaviour, COUNT(*) AS cnt FROM behaviour GROUP BY 1, 2")
def _(spark, sf):
    b = tables.behaviour(tables.event_stream(spark, sf))
    counts = b.groupBy((F.col("user_id") % 4).alias("channel"), "behaviour").agg(F.count(F.lit(1)).alias("cnt"))
    return runner.run_update(counts, "channels", ["channel", "behaviour"])


@query("g1_running_state_stream", "SELECT user_id, CAST(SUM(k) AS BIGINT) AS total FROM ev GROUP BY 1")
def _(spark, sf):
    b = tables.behaviour(tables.event_stream(spark, sf))
    return runner.run_update(b.groupBy("user_id").agg(F.sum("item_id").alias("total")), "totals", ["user_id"])


# --- folders of files, read in several batches ------------------------------------

ROWS_PER_FILE = 2_000
FILES = 50  # a batch costs the same however small it is, so a larger table makes larger files


@query("a11_line_stream", same_as="d1_word_count_stream")
def _(spark, sf):
    """A folder of text files, four to a batch."""
    path = scratch_dir(spark, "lines")
    lines = tables.table(spark, sf, "events").select(F.concat_ws(" ", "event_type", "props").alias("value"))
    files.in_files(lines, ROWS_PER_FILE, FILES).write.text(path)
    words = files.line_stream(spark, path, 4).select(F.explode(F.split("value", " ")).alias("word"))
    return runner.run_update(words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt")), "line-words", ["word"])


@query("a15_queue_of_batches_stream", same_as="g1_running_state_stream")
def _(spark, sf):
    """A queue of files, each of which is a batch."""
    path = scratch_dir(spark, "queue")
    given = tables.table(spark, sf, "events")
    files.in_files(given, 5 * ROWS_PER_FILE, FILES // 5).write.parquet(path)
    b = tables.behaviour(tables.with_instant(files.file_per_batch_stream(spark, path, given.schema)))
    return runner.run_update(b.groupBy("user_id").agg(F.sum("item_id").alias("total")), "queue-totals", ["user_id"])


@query("g14_resumed_counts_stream", same_as="d20_counts_stream")
def _(spark, sf):
    """Half of the input, a graceful stop, and the rest from the same checkpoint."""
    path, out = scratch_dir(spark, "halves"), scratch_dir(spark, "resumed")
    given = tables.table(spark, sf, "events")
    for half in (0, 1):
        given.where(F.col("event_id") % 2 == half).write.mode("append").parquet(path)
        b = tables.behaviour(tables.with_instant(spark.readStream.schema(given.schema).parquet(path)))
        counts = b.groupBy((F.col("user_id") % 4).alias("channel"), "behaviour").agg(F.count(F.lit(1)).alias("cnt"))
        result = runner.run_update(counts, "resumed", ["channel", "behaviour"], out=out, available_now=False)
    return result


# --- joins ---------------------------------------------------------------------

@query("c4_batch_join_stream", f"""
    SELECT {BATCH} AS batch_id, event_id AS tx_id, us AS l_us, us + (event_id % 11 - 4) * 1000000 AS r_us
    FROM ev WHERE event_type = 'purchase' AND event_id % 3 <> 0""")
def _(spark, sf):
    """Pays and receipts that arrive in the same micro-batch."""
    def run(e, out):
        pays = tables.order_events(e).where("event_type = 'pay'").select("tx_id", F.lit("pay").alias("side"), us("ts", "us"))
        both = pays.unionByName(tables.receipts(e).select("tx_id", F.lit("receipt").alias("side"), us("ts", "us")))
        pairs = joins.batch_join(both, F.col("side") == "pay", F.col("side") == "receipt", "tx_id", ["us"])
        return runner.run_batches(both, "batch-join", lambda b, i, out: runner.write_batch(pairs(b, i), i, out), out=out)

    out = event_turns(spark, sf, "batch-join", run)
    return spark.read.option("basePath", f"{out}/rows").parquet(f"{out}/rows").drop("batch")


def pays_and_receipts(spark, sf):
    pays = closed(spark, sf, tables.order_events, "event_type = 'pay'")
    return pays, closed(spark, sf, tables.receipts)


@query("c5_interval_join_stream", INTERVAL_SQL)
def _(spark, sf):
    pays, receipts = pays_and_receipts(spark, sf)
    pairs = joins.interval_join(pays, receipts, "tx_id", "ts", "3 seconds", "5 seconds", "10 seconds")
    out = runner.run_append(pairs, "interval-join")
    return out.select(
        F.col("l_tx_id").alias("tx_id"), F.col("l_order_id").alias("order_id"), F.col("r_channel").alias("channel"),
        us("l_ts", "paid_at"), us("r_ts", "received_at"),
    )


@query("c6_match_with_timeout_stream", TIMEOUT_SQL)
def _(spark, sf):
    pays, receipts = pays_and_receipts(spark, sf)
    both = joins.match_with_timeout(pays, receipts, "tx_id", "ts", "5 seconds", "3 seconds", "10 seconds")
    out = runner.run_append(both, "match").withColumn("at", F.coalesce("l_ts", "r_ts"))
    return runner.without_marker(out, "at").select(
        F.coalesce("l_tx_id", "r_tx_id").alias("tx_id"), us("l_ts", "paid_at"), us("r_ts", "received_at"), "tag"
    )


@query("c7_latest_pairs_stream", LATEST_SQL)
def _(spark, sf):
    """Last create and last pay per order, kept as two running maxima."""
    o = tables.order_events(tables.event_stream(spark, sf))
    last = lambda kind: F.max(
        F.when(F.col("event_type") == kind, F.struct(us("ts", "at"), "event_id"))
    )
    pairs = o.groupBy("order_id").agg(last("create").alias("c"), last("pay").alias("p"))
    out = runner.run_update(pairs, "latest", ["order_id"]).where("c is not null and p is not null")
    return out.select("order_id", F.col("c.event_id").alias("create_id"), F.col("p.event_id").alias("pay_id"))


# --- windows -------------------------------------------------------------------

def counted(spark, sf, view, keep, keys, size, slide, label, *aggs):
    s = closed(spark, sf, view, keep)
    aggs = aggs or [F.count(F.lit(1)).alias("cnt")]
    counts = windows.windowed(s, keys, "ts", "0 seconds", size, slide, *aggs)
    return runner.without_marker(runner.run_append(windows.with_bounds(counts), label), "window_start")


@query("f3_tumbling_count_stream", same_as="f3_tumbling_count")
def _(spark, sf):
    out = counted(spark, sf, tables.sensor, None, ["id"], "10 seconds", None, "tumbling")
    return seconds(out, "window_start", "window_end")


@query("f6_sliding_count_stream", same_as="f6_sliding_count")
def _(spark, sf):
    out = counted(spark, sf, tables.behaviour, "behaviour = 'pv'", ["item_id"], "1 hour", "5 minutes", "sliding")
    return seconds(out.drop("window_start"), "window_end")


@query("f7_hour_by_5s_stream", same_as="f7_hour_by_5s")
def _(spark, sf):
    """The stream keeps panes; the windows are change points over the panes."""
    out = counted(spark, sf, tables.ad_clicks, None, ["province"], "5 seconds", None, "panes")
    steps = panes.change_points(
        out, ["province"], "window_start", "1 hour", "5 seconds", F.col("cnt")
    )
    return seconds(steps, "first_end", "next_end")


@query("e2_best_windows_stream", same_as="e2_best_windows")
def _(spark, sf):
    """An item's windows are ranked over those that the stream has closed."""
    out = counted(spark, sf, tables.behaviour, "behaviour = 'pv'", ["item_id"], "1 hour", "5 minutes", "best-windows")
    best = top_n_per_group(out.drop("window_start"), ["item_id"], [F.desc("cnt"), F.asc("window_end")], 5)
    return seconds(best, "window_end")


@query("f12_tumbling_reduce_stream", same_as="f12_tumbling_reduce")
def _(spark, sf):
    out = counted(
        spark, sf, tables.behaviour, None, ["user_id"], "1 day", None, "reduce",
        F.sum("item_id").alias("total"), F.max("item_id").alias("highest"),
    )
    return seconds(out.drop("window_start"), "window_end")


@query("f13_tumbling_words_stream", same_as="f13_tumbling_words")
def _(spark, sf):
    view = lambda e: e.select(F.col("event_type").alias("word"), "ts")
    out = counted(spark, sf, view, None, ["word"], "6 seconds", None, "window-words")
    return seconds(out.drop("window_start"), "window_end")


@query("f14_invertible_sum_stream", same_as="f14_invertible_sum")
def _(spark, sf):
    """The stream keeps panes of one slide; the sums come and go over the panes."""
    k = F.regexp_extract("props", "[0-9]+", 0).cast("long").alias("k")
    view = lambda e: e.select(F.col("event_type").alias("word"), k, "ts")
    out = counted(spark, sf, view, None, ["word"], "3 seconds", None, "pane-sums", F.sum("k").alias("total"))
    steps = panes.change_points(out, ["word"], "window_start", "9 seconds", "3 seconds", F.col("total"), "total")
    return seconds(steps, "first_end", "next_end")


@query("f15_bucketed_series_stream", same_as="f15_bucketed_series")
def _(spark, sf):
    """The stream counts the small buckets; every window lists its own."""
    out = counted(spark, sf, lambda e: e.select("ts"), None, [], "10 seconds", None, "buckets")
    series = batch_windows.series_of_counts(out, "window_start", "60 seconds", "10 seconds")
    return seconds(series, "window_end", "bucket")


@query("f5_total_views_stream", same_as="f5_total_views")
def _(spark, sf):
    s = closed(spark, sf, tables.behaviour, "behaviour = 'pv'")
    out = runner.run_append(windows.total_views(s, "ts", "0 seconds", "1 hour", "event_id"), "views")
    return seconds(runner.without_marker(out, "window_start").drop("window_start"), "window_end")


@query("f8_hot_items_stream", same_as="e1_hot_items")
def _(spark, sf):
    s = closed(spark, sf, tables.behaviour, "behaviour = 'pv'")
    out = windows.hot_items(s, "item_id", "ts", "0 seconds", "1 hour", "5 minutes", 5, "hot-items")
    return seconds(runner.without_marker(out, "window_end"), "window_end")


@query("f9_hot_pages_stream", same_as="f9_hot_pages")
def _(spark, sf):
    """The log in order of arrival, stamped as its source would: reports are written again for
    late rows, rows that are too late are left out, and closed windows leave the state."""
    log = lateness.with_seen(web_requests(spark, sf), "ts", "arrival", "event_id").select("url", "ts", "arrival", "seen")
    parts = [*by_turns(log, F.unix_micros("arrival"), 3), runner.marker(log, "ts")]

    def run(s, out):
        return refired.refired_hot_pages(
            s, "url", "ts", "1 minute", "1 minute", "10 minutes", "5 seconds", 3, "hot-pages", out, parts=1, seen=F.col("seen")
        )

    return seconds(runner.fed(spark, parts, log.schema, "hot-pages", run), "window_end")


@query("f10_late_rows_stream", same_as="f10_late_rows")
def _(spark, sf):
    s = tables.web_log(tables.event_stream(spark, sf)).where("method = 'GET'")
    out = jobs.late_tag_job(
        s, "ts", "arrival", "event_id", "10 minutes", "5 seconds", "1 minute", "1 minute", "late"
    )
    return out.select("event_id", "late")


@query("f11_session_window_stream", same_as="f11_session_window")
def _(spark, sf):
    s = closed(spark, sf, lambda e: tables.behaviour(e).select(F.col("user_id").alias("key"), "item_id", "ts"))
    out = windows.sessions(
        s, ["key"], "ts", "0 seconds", "1 hour", F.count(F.lit(1)).alias("cnt"), F.sum("item_id").alias("total")
    )
    out = runner.without_marker(runner.run_append(out, "sessions"), "session_start")
    return out.withColumns({c: us(c) for c in ("session_start", "session_end")})


@query("d17_distinct_per_hour_stream", same_as="d17_distinct_per_hour")
def _(spark, sf):
    s = closed(spark, sf)
    out = windows.distinct_per_window(s, "ts", "0 seconds", "1 hour", F.col("user_id"))
    out = runner.without_marker(runner.run_append(out, "uv"), "window_start")
    return seconds(out.drop("window_start"), "window_end")


@query("d18_bitmap_distinct_stream", same_as="d18_bitmap_distinct")
def _(spark, sf):
    s = closed(spark, sf)
    position = bitmap_offset(F.col("user_id").cast("string"))
    out = windows.distinct_per_window(s, "ts", "0 seconds", "1 hour", position)
    out = runner.without_marker(runner.run_append(out, "bitmap"), "window_start")
    return seconds(out.drop("window_start"), "window_end")


@query("d19_running_distinct_stream", same_as="d19_running_distinct")
def _(spark, sf):
    def run(e, out):
        return jobs.running_distinct_job(e.select("user_id", "event_id", "ts"), "user_id", "ts", "event_id", "uv", out)

    return event_turns(spark, sf, "uv", run).select("user_id", "uv")


# --- keyed state ---------------------------------------------------------------

# Nobody waits for the outputs of a history, so its rows may wait for the end of their day
HISTORY_BUCKET = "1 day"


def folded(spark, sf, view, keep, key, cols, fold, label):
    s = closed(spark, sf, view, keep)
    out = keyed.keyed_fold(s, [key], "ts", "event_id", cols, fold, "0 seconds", HISTORY_BUCKET)
    return runner.run_append(out, label)


@query("e3_rolling_rows_stream", same_as="e3_rolling_rows")
def _(spark, sf):
    cents = F.round(F.col("value") * 100).cast("long").cast("double")
    view = lambda e: tables.sensor(e.withColumn("value", cents))
    out = folded(spark, sf, view, None, "id", ["temperature"], folds.Rolling("temperature", 2), "rolling")
    return out.select(F.col("tie").alias("event_id"), "cnt", "mean")


@query("g2_jump_alert_stream", same_as="g2_jump_alert")
def _(spark, sf):
    out = folded(spark, sf, tables.sensor, None, "id", ["temperature"], folds.Jump("temperature", 10.0), "jump")
    return out.select(F.col("tie").alias("event_id"), "last", "current")


@query("g3_jump_alert_from_zero_stream", same_as="g3_jump_alert_from_zero")
def _(spark, sf):
    fold = folds.Jump("temperature", 10.0, first_from_zero=True)
    out = folded(spark, sf, tables.sensor, None, "id", ["temperature"], fold, "jump-zero")
    return out.select(F.col("tie").alias("event_id"), "last", "current")


@query("g4_rise_alert_stream", same_as="g4_rise_alert")
def _(spark, sf):
    out = folded(spark, sf, tables.sensor, None, "id", ["temperature"], folds.Rise("temperature", 6 * HOUR), "rise")
    return out.select(F.col("id").alias("key"), "start", "alert_at")


@query("g5_login_burst_stream", same_as="g5_login_burst")
def _(spark, sf):
    fold = folds.Burst("event_type", 1, 48 * HOUR)
    out = folded(spark, sf, tables.logins, None, "user_id", ["event_type"], fold, "burst")
    return out.select(F.col("user_id").alias("key"), F.col("first_fail").alias("start"), "last_fail", "fails")


@query("g6_login_pair_stream", same_as="g6_login_pair")
def _(spark, sf):
    fold = folds.AdjacentRun("event_type", ["fail", "fail"], 12 * HOUR)
    return folded(spark, sf, tables.logins, None, "user_id", ["event_type"], fold, "pair")


@query("g7_strict_sequence_stream", same_as="g7_strict_sequence")
def _(spark, sf):
    fold = folds.AdjacentRun("event_type", ["fail"] * 3, DAY)
    return folded(spark, sf, tables.logins, None, "user_id", ["event_type"], fold, "strict")


@query("g8_relaxed_sequence_stream", same_as="g8_relaxed_sequence")
def _(spark, sf):
    fold = folds.FollowedBy("event_type", "create", "pay", DAY)
    out = folded(spark, sf, tables.order_events, None, "order_id", ["event_type"], fold, "relaxed")
    return out.select(F.col("tie").alias("event_id"), "end_at", "status")


@query("g8_mixed_pattern_stream", same_as="g8_mixed_pattern")
def _(spark, sf):
    fold = folds.Sequences("event_type", MIXED, MIXED_DAYS * DAY)
    out = folded(spark, sf, None, None, "user_id", ["event_type"], fold, "mixed")
    return out.select("user_id", F.col("first_tie").alias("event_id"), "first_at", "last_at")


@query("g9_order_outcomes_stream", same_as="g9_order_outcomes")
def _(spark, sf):
    fold = folds.OrderOutcome("event_type", DAY, keep_us=60 * DAY)
    out = folded(spark, sf, tables.order_events, None, "order_id", ["event_type"], fold, "outcomes")
    return out.select(F.col("tie").alias("event_id"), "status")


@query("g10_click_filter_stream", same_as="g10_click_filter")
def _(spark, sf):
    s = closed(spark, sf, tables.ad_clicks)
    out = keyed.keyed_fold(s, ["user_id", "ad_id"], "ts", "event_id", [], folds.ClickFilter(1), "0 seconds", HISTORY_BUCKET)
    out = runner.run_append(out, "clicks")
    return out.select(F.col("tie").alias("event_id"), "tag")


@query("g17_changelog_stream", """
    WITH n AS (SELECT user_id, COUNT(*) AS n FROM events GROUP BY 1)
    SELECT user_id, '+' AS op, i AS cnt FROM n, unnest(range(1, n + 1)) AS r(i)
    UNION ALL SELECT user_id, '-', i FROM n, unnest(range(1, n)) AS r(i)""")
def _(spark, sf):
    return folded(spark, sf, None, None, "user_id", [], folds.CountLog(), "changelog")


@query("h14_top_two_stream", same_as="h14_top_two")
def _(spark, sf):
    out = folded(spark, sf, tables.sensor, None, "id", ["temperature"], folds.TopTwo("temperature"), "top-two")
    newest = out.groupBy("id", "rank").agg(F.max_by("value", "version").alias("temperature"))
    return newest.select("id", "rank", "temperature")


# --- tables kept between batches -------------------------------------------------

@query("a20_additive_upsert_stream", """
    SELECT user_id % 5 AS area, event_type AS ad, COUNT(*) AS cnt FROM events GROUP BY 1, 2""")
def _(spark, sf):
    def run(e, out):
        e = e.select((F.col("user_id") % 5).alias("area"), F.col("event_type").alias("ad"))
        return jobs.additive_counts(e, ["area", "ad"], "upsert", out)

    return event_turns(spark, sf, "upsert", run)


def _blacklist_sql(limit: int, batches: int = 5) -> str:
    """The job batch by batch: b* listed before, c* counts, s* counters after."""
    parts = [
        f"clicks AS (SELECT us // 86400000000 AS day, user_id AS usr, k % 2 AS ad, {BATCH} AS batch FROM ev)",
        "b0 AS (SELECT CAST(NULL AS BIGINT) AS usr WHERE FALSE)",
        "s0 AS (SELECT CAST(NULL AS BIGINT) AS day, CAST(NULL AS BIGINT) AS usr, CAST(NULL AS BIGINT) AS ad, "
        "CAST(NULL AS BIGINT) AS cnt WHERE FALSE)",
    ]
    for i in range(batches):
        parts += [
            f"c{i} AS (SELECT day, usr, ad, COUNT(*) AS cnt FROM clicks WHERE batch = {i} AND usr NOT IN (SELECT usr FROM b{i}) GROUP BY ALL)",
            f"b{i + 1} AS (SELECT usr FROM b{i} UNION SELECT usr FROM c{i} WHERE cnt >= {limit} UNION "
            f"SELECT usr FROM c{i} JOIN s{i} USING (day, usr, ad) WHERE c{i}.cnt < {limit} AND c{i}.cnt + s{i}.cnt >= {limit})",
            f"s{i + 1} AS (SELECT day, usr, ad, CAST(SUM(cnt) AS BIGINT) AS cnt FROM (SELECT * FROM s{i} UNION ALL "
            f"SELECT * FROM c{i} WHERE cnt < {limit}) GROUP BY ALL)",
        ]
    return (
        "WITH " + ", ".join(parts) + f" SELECT day, usr, ad, cnt, usr IN (SELECT usr FROM b{batches}) AS listed FROM s{batches}"
    )


@query("g12_blacklist_stream", _blacklist_sql(4))
def _(spark, sf):
    def run(e, out):
        clicks = e.select(
            F.unix_date(F.to_date("ts")).cast("long").alias("day"), F.col("user_id").alias("usr"),
            (F.regexp_extract("props", "[0-9]+", 0).cast("long") % 2).alias("ad"),
        )
        return jobs.blacklist_job(clicks, "day", "usr", "ad", 4, "blacklist", out)

    listed, counters = event_turns(spark, sf, "blacklist", run)
    mark = listed.withColumn("listed", F.lit(True))
    return counters.join(mark, "usr", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))


# --- late rows as a second output, and streams that begin with a history ----------

_LATE_JUMPS = """
    WITH s AS (SELECT *, us + (event_id % 7) * 86400000000 AS arrival FROM sensor),
    t AS (SELECT *, (arrival - MIN(arrival) OVER ()) * 4 // (MAX(arrival) OVER () - MIN(arrival) OVER () + 1) AS turn FROM s),
    m AS (SELECT turn, MAX(us) AS top FROM t GROUP BY 1),
    w AS (SELECT a.turn, MAX(b.top) // 1000 * 1000 - 86400000000 AS passed FROM m a LEFT JOIN m b ON b.turn < a.turn GROUP BY 1),
    r AS (SELECT *, COALESCE(us < passed, FALSE) AS late FROM t JOIN w USING (turn)),
    k AS (SELECT event_id, us, lag(temperature) OVER (PARTITION BY id ORDER BY us, event_id) AS last, temperature AS current FROM r WHERE NOT late)
    SELECT event_id, FALSE AS late, last, current FROM k WHERE abs(last - current) > 10
    UNION ALL SELECT event_id, TRUE, NULL, NULL FROM r WHERE late"""


@query("g2_jumps_and_late_rows_stream", _LATE_JUMPS)
def _(spark, sf):
    """Readings that come up to six days late, one day of which is waited for: the alerts over
    those in time, and the others by themselves. Every reading is one or the other."""
    days = F.make_dt_interval(days=(F.col("event_id") % 7).cast("int"))
    readings = tables.sensor(tables.events(spark, sf)).withColumn("arrival", F.col("ts") + days)
    parts = [*by_turns(readings, F.unix_micros("arrival"), 4), runner.marker(readings, "ts")]

    def run(s, out):
        fold = folds.Jump("temperature", 10.0)
        both = keyed.keyed_fold(s, ["id"], "ts", "event_id", ["temperature"], fold, "1 day", HISTORY_BUCKET, late=True)
        return runner.run_append(both, "late-jumps", out)

    out = runner.fed(spark, parts, readings.schema, "late-jumps", run)
    return out.select(
        F.coalesce("late_tie", "tie").alias("event_id"), F.col("late_tie").isNotNull().alias("late"), "last", "current"
    )


def history_and_tail(spark, sf, view, keys, cols, fold, label, batch):
    """The outputs of ``batch`` over the first half of the time, and of a stream over the rest
    that begins with what the keys remember of it; both as the fold's columns."""
    rows = view(tables.events(spark, sf))
    history, tail = by_turns(rows, F.unix_micros("ts"), 2)
    begin = fold.after(history, keys, "ts", "event_id")

    def run(s, out):
        return runner.run_append(keyed.keyed_fold(s, keys, "ts", "event_id", cols, fold, "0 seconds", HISTORY_BUCKET, initial=begin), label, out)

    whole = tail.unionByName(runner.marker(tail, "ts"))
    return batch(history), runner.fed(spark, [whole], rows.schema, label, run)


@query("g14_history_then_jumps_stream", same_as="g2_jump_alert")
def _(spark, sf):
    before, after = history_and_tail(
        spark, sf, tables.sensor, ["id"], ["temperature"], folds.Jump("temperature", 10.0), "then-jumps",
        lambda df: ordered.jump_alerts(df, "id", "ts", "event_id", "temperature", 10.0),
    )
    return before.select("event_id", "last", "current").union(after.select("tie", "last", "current"))


@query("g14_history_then_clicks_stream", same_as="g10_click_filter")
def _(spark, sf):
    before, after = history_and_tail(
        spark, sf, tables.ad_clicks, ["user_id", "ad_id"], [], folds.ClickFilter(1), "then-clicks",
        lambda df: patterns.click_filter(df, ["user_id", "ad_id"], "ts", "event_id", 1),
    )
    return before.select("event_id", "tag").union(after.select("tie", "tag"))


# --- sinks that write by partition -------------------------------------------------

@query("g16_partition_sink", "SELECT user_id, event_type, COUNT(*) AS cnt FROM events GROUP BY 1, 2")
def _(spark, sf):
    """Counts written by partition with one commit, and read back from what was committed."""
    counts = tables.table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("cnt"))
    folder = scratch_dir(spark, "parts")
    sinks.write_parts(counts, folder)
    return sinks.read_parts(spark, folder, "user_id long, event_type string, cnt long")


@query("g16_partition_sink_stream", "SELECT event_id, user_id, event_type FROM events")
def _(spark, sf):
    """Every batch of a stream written by partition, with a commit of its own."""
    folder = scratch_dir(spark, "stream-parts")

    def run(e, out):
        return runner.run_sink(
            e.select("event_id", "user_id", "event_type"), "stream-parts",
            lambda w: w.format("parts").option("path", folder), out,
        )

    spark.dataSource.register(sinks.PartsSink)
    event_turns(spark, sf, "stream-parts", run, batches=3)
    return sinks.read_parts(spark, folder, "event_id long, user_id long, event_type string")
