"""Time windows and lateness over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import query, us
from tidemark.operators import lateness, ordered, patterns, windows
from tidemark.plans import extremes, panes
from tidemark.sources import tables

ev = tables.events

# SQL for all windows of size S and slide L (seconds): each row joins its S/L window ends
_SLIDING = """SELECT {key}, w.e AS window_end, COUNT(*) AS cnt FROM {src},
    unnest(range(us // 1000000 // {slide} * {slide} + {slide}, us // 1000000 // {slide} * {slide} + {size} + 1, {slide})) AS w(e)
    {where} GROUP BY ALL"""


def sliding_sql(src, key, size, slide, where=""):
    return _SLIDING.format(src=src, key=key, size=size, slide=slide, where=where)


# change points of the same: +n at pane end, -n when the pane leaves the window
_STEPS = """WITH p AS (SELECT {key}, us // 1000000 // {slide} * {slide} AS p, COUNT(*) AS n FROM {src} {where} GROUP BY ALL),
    d AS (SELECT {key}, p + {slide} AS t0, n AS d FROM p UNION ALL SELECT {key}, p + {size} + {slide}, -n FROM p),
    s AS (SELECT {key}, t0, SUM(d) AS d FROM d GROUP BY ALL HAVING SUM(d) <> 0),
    c AS (SELECT {key}, t0 AS first_end, lead(t0) OVER (PARTITION BY {key} ORDER BY t0) AS next_end,
          CAST(SUM(d) OVER (PARTITION BY {key} ORDER BY t0) AS BIGINT) AS cnt FROM s)
    SELECT * FROM c WHERE cnt <> 0"""


def steps_sql(src, key, size, slide, where=""):
    return _STEPS.format(src=src, key=key, size=size, slide=slide, where=where)


def pv(spark, sf):
    # filtered on the stored column, so that the scan can skip row groups
    return tables.behaviour(ev(spark, sf).where("event_type = 'view'"))


def seconds(df, *cols):
    return df.withColumns({c: F.unix_seconds(c) for c in cols})


@query("e1_hot_items", f"""
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS rank FROM
    ({sliding_sql('behaviour', 'item_id', 3600, 300, "WHERE behaviour = 'pv'")})) WHERE rank <= 5""")
def _(spark, sf):
    return seconds(windows.hot_items(pv(spark, sf), "item_id", "ts", "1 hour", "5 minutes", 5), "window_end")


@query("e2_best_windows", f"""
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY cnt DESC, window_end) AS rank FROM
    ({sliding_sql('behaviour', 'item_id', 3600, 300, "WHERE behaviour = 'pv'")})) WHERE rank <= 5""")
def _(spark, sf):
    return seconds(windows.best_windows(pv(spark, sf), "item_id", "ts", "1 hour", "5 minutes", 5), "window_end")


@query("e3_rolling_rows", """
    WITH c AS (SELECT *, CAST(round(temperature * 100) AS BIGINT) AS cents FROM sensor)
    SELECT event_id, COUNT(*) OVER w AS cnt, CAST(SUM(cents) OVER w AS DOUBLE) / COUNT(*) OVER w AS mean FROM c
    WINDOW w AS (PARTITION BY id ORDER BY us, event_id ROWS 2 PRECEDING)""")
def _(spark, sf):
    s = tables.sensor(ev(spark, sf)).withColumn(
        "cents", F.round(F.col("temperature") * 100).cast("long").cast("double")
    )
    return ordered.rolling_rows(s, ["id"], "ts", "event_id", "cents", 2).select("event_id", "cnt", "mean")


@query("e4_page_flow", """
    WITH n AS (SELECT page_id, lead(page_id) OVER (PARTITION BY session_id ORDER BY us, event_id) AS nxt FROM visit),
    m AS (SELECT page_id, nxt, COUNT(*) AS moves FROM n WHERE nxt = page_id + 1 AND page_id BETWEEN 1 AND 6 GROUP BY 1, 2),
    v AS (SELECT page_id, COUNT(*) AS visits FROM visit GROUP BY 1)
    SELECT m.page_id AS from_page, nxt AS to_page, moves, visits, CAST(moves AS DOUBLE) / visits AS conversion
    FROM m JOIN v ON m.page_id = v.page_id""")
def _(spark, sf):
    return ordered.page_flow(
        tables.visits(ev(spark, sf)), "session_id", "ts", "event_id", "page_id", [1, 2, 3, 4, 5, 6, 7]
    )


@query("f3_tumbling_count", """
    SELECT id, us // 10000000 * 10 AS window_start, us // 10000000 * 10 + 10 AS window_end, COUNT(*) AS cnt
    FROM sensor GROUP BY 1, 2, 3""")
def _(spark, sf):
    s = tables.sensor(ev(spark, sf))
    out = windows.tumbling(s, ["id"], "ts", "10 seconds", F.count(F.lit(1)).alias("cnt"))
    return seconds(out, "window_start", "window_end")


@query("f4_tumbling_count_mean", """
    WITH c AS (SELECT id, us // 3600000000 * 3600 + 3600 AS window_end, CAST(round(temperature * 100) AS BIGINT) AS cents FROM sensor)
    SELECT id, window_end, COUNT(*) AS cnt, CAST(SUM(cents) AS DOUBLE) / COUNT(*) AS mean FROM c GROUP BY 1, 2""")
def _(spark, sf):
    s = tables.sensor(ev(spark, sf))
    cents = F.round(F.col("temperature") * 100).cast("long")
    out = windows.tumbling(
        s, ["id"], "ts", "1 hour", F.count(F.lit(1)).alias("cnt"), F.avg(cents).alias("mean")
    )
    return seconds(out.drop("window_start"), "window_end")


@query("f5_total_views", """
    SELECT us // 3600000000 * 3600 + 3600 AS window_end, COUNT(*) AS cnt FROM behaviour WHERE behaviour = 'pv' GROUP BY 1""")
def _(spark, sf):
    hourly = windows.tumbling(
        pv(spark, sf), ["category_id"], "ts", "1 hour", F.count(F.lit(1)).alias("n")
    )
    return seconds(hourly.groupBy("window_end").agg(F.sum("n").alias("cnt")), "window_end")


@query("f6_sliding_count", sliding_sql("behaviour", "item_id", 3600, 300, "WHERE behaviour = 'pv'"))
def _(spark, sf):
    return seconds(panes.sliding(pv(spark, sf), ["item_id"], "ts", "1 hour", "5 minutes"), "window_end")


@query("f7_hour_by_5s", steps_sql("ad_click", "province", 3600, 5))
def _(spark, sf):
    clicks = tables.ad_clicks(ev(spark, sf)).select("province", "ts")
    return seconds(panes.change_points(clicks, ["province"], "ts", "1 hour", "5 seconds"), "first_end", "next_end")


_MARKET = "(SELECT 'channel' || CAST(user_id % 4 AS VARCHAR) AS channel, behaviour, us FROM behaviour) m"


def market(spark, sf):
    b = tables.behaviour(ev(spark, sf))
    return b.select(F.concat(F.lit("channel"), (F.col("user_id") % 4).cast("string")).alias("channel"), "behaviour", "ts")


@query("f7_day_by_5s", steps_sql(_MARKET, "channel, behaviour", 86400, 5))
def _(spark, sf):
    steps = panes.change_points(market(spark, sf), ["channel", "behaviour"], "ts", "1 day", "5 seconds")
    return seconds(steps, "first_end", "next_end")


@query("f7_pages_10min_by_5s", steps_sql("web_log", "url", 600, 5, "WHERE method = 'GET'"))
def _(spark, sf):
    log = tables.web_log(ev(spark, sf).where("event_type IN ('view', 'click')")).select("url", "ts")
    steps = panes.change_points(log, ["url"], "ts", "10 minutes", "5 seconds")
    return seconds(steps, "first_end", "next_end")


_LATE = """
    SELECT *, COALESCE(us // 5000000 * 5000000 + 600000000 + 60000000 <= MAX(us) OVER (ORDER BY arrival, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 60000000, FALSE) AS late
    FROM web_log WHERE method = 'GET'"""


def web_requests(spark, sf):
    """The ``GET`` requests of the web log."""
    return tables.web_log(ev(spark, sf).where("event_type IN ('view', 'click')"))


def tagged_log(spark, sf):
    return lateness.tag_late(
        web_requests(spark, sf), "ts", "arrival", "event_id", "10 minutes", "5 seconds", "1 minute", "1 minute"
    )


@query("f9_hot_pages", f"""
    WITH t AS ({_LATE}), w AS ({sliding_sql('t', 'url', 600, 5, 'WHERE NOT late')})
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS rank FROM w)
    WHERE rank <= 3""")
def _(spark, sf):
    """Final report per window: the top pages among the rows that came in time."""
    kept = tagged_log(spark, sf).where("NOT late")
    return seconds(windows.hot_items(kept, "url", "ts", "10 minutes", "5 seconds", 3), "window_end")


@query("f10_late_rows", f"SELECT event_id, late FROM ({_LATE})")
def _(spark, sf):
    return tagged_log(spark, sf).select("event_id", "late")


_SESSIONS = """
    WITH n AS (SELECT {key} AS key, us, k, CASE WHEN us - lag(us) OVER (PARTITION BY {key} ORDER BY us) <= {gap} THEN 0 ELSE 1 END AS new
               FROM ev), s AS (SELECT *, SUM(new) OVER (PARTITION BY key ORDER BY us) AS sid FROM n)
    SELECT key, MIN(us) AS session_start, MAX(us) + {gap} AS session_end, COUNT(*) AS cnt, CAST(SUM(k) AS BIGINT) AS total
    FROM s GROUP BY key, sid"""


@query("f11_session_window", _SESSIONS.format(key="user_id", gap=3600000000))
def _(spark, sf):
    b = tables.behaviour(ev(spark, sf)).select(F.col("user_id").alias("key"), "item_id", "ts")
    out = windows.sessions(b, ["key"], "ts", "1 hour", F.col("item_id"))
    return out.withColumns({c: us(c) for c in ("session_start", "session_end")})


@query("f12_tumbling_reduce", """
    SELECT user_id, us // 86400000000 * 86400 + 86400 AS window_end, CAST(SUM(k) AS BIGINT) AS total, MAX(k) AS highest
    FROM ev GROUP BY 1, 2""")
def _(spark, sf):
    b = tables.behaviour(ev(spark, sf))
    out = windows.tumbling(
        b, ["user_id"], "ts", "1 day", F.sum("item_id").alias("total"), F.max("item_id").alias("highest")
    )
    return seconds(out.drop("window_start"), "window_end")


@query("f12_sliding_highest", """
    WITH p AS (SELECT id, us // 5000000 * 5000000 AS pane, MAX(temperature) AS v FROM sensor GROUP BY 1, 2),
    e AS (SELECT id, pane + 5000000 AS w FROM p UNION SELECT id, pane + 3605000000 FROM p),
    v AS (SELECT e.id, w, (SELECT MAX(v) FROM p WHERE p.id = e.id AND pane >= w - 3600000000 AND pane < w) AS highest FROM e),
    n AS (SELECT *, lead(w) OVER (PARTITION BY id ORDER BY w) AS next_w FROM v)
    SELECT id, w // 1000000 AS first_end, next_w // 1000000 AS next_end, highest FROM n WHERE highest IS NOT NULL""")
def _(spark, sf):
    """The highest temperature of the last hour, every five seconds."""
    out = extremes.sliding_extreme(tables.sensor(ev(spark, sf)), ["id"], "ts", "1 hour", "5 seconds", F.col("temperature"))
    return seconds(out, "first_end", "next_end")


@query("f13_tumbling_words", """
    SELECT event_type AS word, us // 6000000 * 6 + 6 AS window_end, COUNT(*) AS cnt FROM ev GROUP BY 1, 2""")
def _(spark, sf):
    e = ev(spark, sf).select(F.col("event_type").alias("word"), "ts")
    out = windows.tumbling(e, ["word"], "ts", "6 seconds", F.count(F.lit(1)).alias("cnt"))
    return seconds(out.drop("window_start"), "window_end")


@query("f14_invertible_sum", """
    WITH p AS (SELECT event_type AS word, us // 3000000 * 3 AS p, CAST(SUM(k) AS BIGINT) AS n FROM ev GROUP BY ALL),
    d AS (SELECT word, p + 3 AS t0, n AS d FROM p UNION ALL SELECT word, p + 12, -n FROM p),
    s AS (SELECT word, t0, SUM(d) AS d FROM d GROUP BY ALL HAVING SUM(d) <> 0),
    c AS (SELECT word, t0 AS first_end, lead(t0) OVER (PARTITION BY word ORDER BY t0) AS next_end,
          CAST(SUM(d) OVER (PARTITION BY word ORDER BY t0) AS BIGINT) AS total FROM s)
    SELECT * FROM c WHERE total <> 0""")
def _(spark, sf):
    e = ev(spark, sf).select(
        F.col("event_type").alias("word"), F.regexp_extract("props", "[0-9]+", 0).cast("long").alias("k"), "ts"
    )
    out = panes.change_points(e, ["word"], "ts", "9 seconds", "3 seconds", F.col("k"), "total")
    return seconds(out, "first_end", "next_end")


@query("f15_bucketed_series", """
    WITH b AS (SELECT us // 10000000 * 10 AS bucket, COUNT(*) AS cnt FROM ev GROUP BY 1)
    SELECT w.e AS window_end, bucket, cnt FROM b,
    unnest(range(bucket + 10, bucket + 61, 10)) AS w(e)""")
def _(spark, sf):
    e = ev(spark, sf).select("ts")
    return seconds(windows.bucketed_series(e, "ts", "10 seconds", "60 seconds", "10 seconds"), "window_end", "bucket")


@query("f17_window_function", """
    SELECT event_type, us // 3600000000 * 3600 + 3600 AS window_end, COUNT(*) AS n, MAX(k) - MIN(k) AS spread
    FROM ev GROUP BY 1, 2""")
def _(spark, sf):
    e = ev(spark, sf).select("event_type", "ts", F.regexp_extract("props", "[0-9]+", 0).cast("long").alias("k"))
    spread = (F.max("k") - F.min("k")).alias("spread")
    out = windows.tumbling(e, ["event_type"], "ts", "1 hour", F.count(F.lit(1)).alias("n"), spread)
    return seconds(out.drop("window_start"), "window_end")


@query("g11_clicks_by_province", f"""
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id, ad_id, us // 86400000000 ORDER BY us, event_id) AS rn FROM ad_click),
    f AS (SELECT province, us FROM r WHERE rn <= 1), {steps_sql('f', 'province', 3600, 5)[5:]}""")
def _(spark, sf):
    clicks = tables.ad_clicks(ev(spark, sf))
    passed = patterns.click_filter(clicks, ["user_id", "ad_id"], "ts", "event_id", 1).where("tag = 'pass'")
    steps = panes.change_points(passed.select("province", "ts"), ["province"], "ts", "1 hour", "5 seconds")
    return seconds(steps, "first_end", "next_end")
