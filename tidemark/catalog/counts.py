"""Aggregations, rankings and distinct counts over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.basics import ad_lines
from tidemark.catalog.registry import query
from tidemark.functions.scalar import day_of_millis
from tidemark.operators import aggregates as agg
from tidemark.operators import distinct, windows
from tidemark.sources import lines, tables

ev = tables.events


@query("d1_word_count", """
    SELECT word, COUNT(*) AS cnt FROM (SELECT unnest(string_split_regex(text, '\\s+')) AS word FROM documents)
    WHERE word <> '' GROUP BY word""")
def _(spark, sf):
    return agg.word_count(tables.table(spark, sf, "documents"), "text")


@query("d2_composite_count", "SELECT province, ad_id, COUNT(*) AS cnt FROM ad_click GROUP BY 1, 2")
def _(spark, sf):
    return agg.count_by(tables.ad_clicks(ev(spark, sf)), ["province", "ad_id"])


@query("d3_top_ads_per_province", """
    SELECT province, ad_id, cnt, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY province ORDER BY cnt DESC, ad_id) AS rank
      FROM (SELECT province, ad_id, COUNT(*) AS cnt FROM ad_click GROUP BY 1, 2)) WHERE rank <= 3""")
def _(spark, sf):
    counts = agg.count_by(tables.ad_clicks(ev(spark, sf)), ["province", "ad_id"])
    return agg.top_n_per_group(counts, ["province"], [F.desc("cnt"), F.asc("ad_id")], 3)


@query("d4_two_rule_fold", """
    SELECT user_id, CAST(SUM(m) AS BIGINT) AS total FROM
    (SELECT user_id, event_id % 4 AS part, MAX(k) AS m FROM ev GROUP BY 1, 2) GROUP BY 1""")
def _(spark, sf):
    b = tables.behaviour(ev(spark, sf)).withColumn("part", F.col("event_id") % 4)
    return agg.two_rule_fold(b, ["user_id"], "part", "item_id")


@query("d5_fold_by_key", "SELECT user_id, CAST(SUM(k) AS BIGINT) AS total FROM ev GROUP BY 1")
def _(spark, sf):
    return tables.behaviour(ev(spark, sf)).groupBy("user_id").agg(F.sum("item_id").alias("total"))


@query("d6_integer_mean", "SELECT user_id, CAST(SUM(k) AS BIGINT) // COUNT(*) AS mean FROM ev GROUP BY 1")
def _(spark, sf):
    return agg.mean_by_key(tables.behaviour(ev(spark, sf)), ["user_id"], F.col("item_id"))


@query("d7_sum_of_maxima", """
    SELECT CAST(SUM(m) AS BIGINT) AS total FROM (SELECT MAX(k) AS m FROM ev GROUP BY event_id % 4)""")
def _(spark, sf):
    b = tables.behaviour(ev(spark, sf)).withColumn("part", F.col("event_id") % 4)
    return agg.two_rule_fold(b, [], "part", "item_id")


_ADDITIVE = """
    SELECT category_id, COUNT(*) FILTER (kind = 'c') AS clicks, COUNT(*) FILTER (kind = 'o') AS orders,
           COUNT(*) FILTER (kind = 'p') AS pays FROM (
      SELECT click_category_id AS category_id, 'c' AS kind FROM visit WHERE click_category_id IS NOT NULL
      UNION ALL SELECT unnest(string_split(order_category_ids, ',')), 'o' FROM visit WHERE order_category_ids IS NOT NULL
      UNION ALL SELECT unnest(string_split(pay_category_ids, ',')), 'p' FROM visit WHERE pay_category_ids IS NOT NULL)
    GROUP BY 1"""
_EXCLUSIVE = """
    SELECT category_id, COUNT(*) FILTER (kind = 'c') AS clicks, COUNT(*) FILTER (kind = 'o') AS orders,
           COUNT(*) FILTER (kind = 'p') AS pays FROM (
      SELECT click_category_id AS category_id, 'c' AS kind FROM visit WHERE click_category_id IS NOT NULL
      UNION ALL SELECT unnest(string_split(order_category_ids, ',')), 'o' FROM visit
        WHERE click_category_id IS NULL AND order_category_ids IS NOT NULL
      UNION ALL SELECT unnest(string_split(pay_category_ids, ',')), 'p' FROM visit
        WHERE click_category_id IS NULL AND order_category_ids IS NULL AND pay_category_ids IS NOT NULL)
    GROUP BY 1"""
_RANKED = "SELECT * FROM ({}) ORDER BY clicks DESC, orders DESC, pays DESC, category_id LIMIT 10"


def category_counts(spark, sf, exclusive):
    return agg.category_counts(
        tables.visits(ev(spark, sf)), "click_category_id", "order_category_ids", "pay_category_ids",
        exclusive,
    )


@query("d8_category_ranking", _RANKED.format(_ADDITIVE))
def _(spark, sf):
    return agg.category_ranking(category_counts(spark, sf, exclusive=False), 10)


@query("d9_category_ranking_exclusive", _RANKED.format(_EXCLUSIVE))
def _(spark, sf):
    return agg.category_ranking(category_counts(spark, sf, exclusive=True), 10)


@query("d10_top_sessions", f"""
    WITH top AS ({_RANKED.format(_EXCLUSIVE)}),
    n AS (SELECT click_category_id, session_id, COUNT(*) AS cnt FROM visit
          WHERE click_category_id IN (SELECT category_id FROM top) GROUP BY 1, 2)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY click_category_id ORDER BY cnt DESC, session_id) AS rank
                   FROM n) WHERE rank <= 10""")
def _(spark, sf):
    return agg.top_sessions_of_top_categories(tables.visits(ev(spark, sf)), 10, 10)


@query("d11_running_sum", """
    SELECT event_id, CAST(SUM(k) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING)
    AS BIGINT) AS total FROM ev""")
def _(spark, sf):
    b = tables.behaviour(ev(spark, sf)).select("event_id", "user_id", "item_id", "ts")
    return agg.running_sum(b, ["user_id"], "ts", "event_id", F.col("item_id")).select("event_id", "total")


@query("d12_keyed_max_sum", """
    SELECT user_id, MAX(k) AS highest, CAST(SUM(k) AS BIGINT) AS total FROM ev GROUP BY 1""")
def _(spark, sf):
    b = tables.behaviour(ev(spark, sf))
    return b.groupBy("user_id").agg(F.max("item_id").alias("highest"), F.sum("item_id").alias("total"))


@query("d13_accumulated_sum", "SELECT CAST(SUM(k) AS BIGINT) AS total FROM ev")
def _(spark, sf):
    """The sum is read from the side of a job that writes the rows somewhere."""
    rows, seen = agg.observed_sum(tables.behaviour(ev(spark, sf)), F.col("item_id"))
    rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(seen.get["total"],)], "total long")


@query("d14_word_count_map", """
    SELECT lang, word, COUNT(*) AS cnt FROM
    (SELECT lang, unnest(string_split_regex(text, '\\s+')) AS word FROM documents) WHERE word <> '' GROUP BY 1, 2""")
def _(spark, sf):
    """Counts as maps spread over many rows, read back entry by entry."""
    docs = tables.table(spark, sf, "documents")
    words = docs.select("lang", F.explode(F.split("text", "\\s+")).alias("word")).where("word <> ''")
    counts = agg.count_by(words, ["lang", "word"]).select(F.struct("lang", "word").alias("key"), "cnt")
    maps = agg.count_map(counts, "key", maps=64)
    return maps.select(F.explode("counts").alias("key", "cnt")).select("key.lang", "key.word", "cnt")


@query("d15_category_accumulator", _EXCLUSIVE)
def _(spark, sf):
    return category_counts(spark, sf, exclusive=True)


@query("d16_average", "SELECT CAST(SUM(k) AS DOUBLE) / COUNT(*) AS mean FROM ev")
def _(spark, sf):
    return tables.behaviour(ev(spark, sf)).agg(F.avg("item_id").alias("mean"))


@query("d17_distinct_per_hour", """
    SELECT us // 3600000000 * 3600 + 3600 AS window_end, COUNT(DISTINCT user_id) AS cnt FROM ev GROUP BY 1""")
def _(spark, sf):
    e = ev(spark, sf).select("user_id", windows.window_end("ts", "1 hour").alias("window_end"))
    out = e.groupBy("window_end").agg(F.count_distinct("user_id").alias("cnt"))
    return out.withColumn("window_end", F.unix_seconds("window_end"))


# ids here have at most a few digits, so the hash is the plain polynomial below 2^32
@query("d18_bitmap_distinct", """
    WITH h AS (SELECT us // 3600000000 * 3600 + 3600 AS window_end,
      list_reduce(list_prepend(0::BIGINT, list_transform(string_split(CAST(user_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
                  lambda a, c: (a * 61 + c) % 4294967296) & 536870911 AS pos FROM ev)
    SELECT window_end, COUNT(DISTINCT pos) AS cnt FROM h GROUP BY 1""")
def _(spark, sf):
    e = ev(spark, sf).select("user_id", "ts")
    out = agg.bitmap_distinct(e, windows.window_end("ts", "1 hour"), F.col("user_id").cast("string"))
    return out.withColumn("window_end", F.unix_seconds("window_end"))


def _sliding_users(position: str) -> str:
    return f"""
    SELECT w.e AS window_end, COUNT(DISTINCT {position}) AS cnt
    FROM ev, unnest(range(us // 300000000 * 300 + 300, us // 300000000 * 300 + 3601, 300)) AS w(e) GROUP BY 1"""


@query("d18_sliding_bitmaps", _sliding_users("user_id"))
def _(spark, sf):
    """Users of the last hour every five minutes: a bitmap per pane, joined to those of windows."""
    e = ev(spark, sf).select("user_id", "ts")
    out = distinct.sliding_bitmap_distinct(e, [], "ts", "1 hour", "5 minutes", F.col("user_id"))
    return out.withColumn("window_end", F.unix_seconds("window_end"))


# three standard errors of a sketch, and one for rounding
@query("d17_sliding_sketches", f"SELECT window_end, cnt, TRUE AS close FROM ({_sliding_users('user_id')})")
def _(spark, sf):
    """The same windows from sketches, beside the exact count: close if within three standard errors."""
    e = ev(spark, sf).select("user_id", "ts")
    about = distinct.sliding_sketch_distinct(e, [], "ts", "1 hour", "5 minutes", F.col("user_id"), name="about")
    exact = distinct.sliding_bitmap_distinct(e, [], "ts", "1 hour", "5 minutes", F.col("user_id"))
    bound = 3 * 0.83 / 2 ** (distinct.LOG_REGISTERS / 2)
    close = F.abs(F.col("about") - F.col("cnt")) <= F.col("cnt") * bound + 1
    return exact.join(about, "window_end").select(F.unix_seconds("window_end").alias("window_end"), "cnt", close.alias("close"))


@query("d19_running_distinct", """
    SELECT user_id, row_number() OVER (ORDER BY first_us, user_id) AS uv FROM
    (SELECT user_id, MIN(us) AS first_us FROM ev GROUP BY user_id)""")
def _(spark, sf):
    e = ev(spark, sf).select("user_id", "event_id", "ts")
    return agg.running_distinct(e, "user_id", "ts", "event_id").select("user_id", "uv")


@query("d20_running_count", """
    SELECT event_id, COUNT(*) OVER (PARTITION BY user_id % 4, behaviour ORDER BY us, event_id
    ROWS UNBOUNDED PRECEDING) AS cnt FROM behaviour""")
def _(spark, sf):
    b = tables.behaviour(ev(spark, sf)).select(
        "event_id", (F.col("user_id") % 4).alias("channel"), "behaviour", "ts"
    )
    return agg.running_count(b, ["channel", "behaviour"], "ts", "event_id").select("event_id", "cnt")


@query("d21_weekly_signins", """
    SELECT user_id, CAST(SUM(CASE WHEN us // 86400000000 % 7 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS a1,
    CAST(SUM(CASE WHEN us // 86400000000 % 7 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS a2,
    CAST(SUM(CASE WHEN us // 86400000000 % 7 = 2 THEN 1 ELSE 0 END) AS BIGINT) AS a3,
    CAST(SUM(CASE WHEN us // 86400000000 % 7 = 3 THEN 1 ELSE 0 END) AS BIGINT) AS a4,
    CAST(SUM(CASE WHEN us // 86400000000 % 7 = 4 THEN 1 ELSE 0 END) AS BIGINT) AS a5
    FROM login GROUP BY 1""")
def _(spark, sf):
    e = tables.logins(ev(spark, sf))
    day = F.pmod(F.unix_date(F.to_date("ts")), F.lit(7))
    return agg.conditional_counts(e, "user_id", {f"a{i + 1}": day == i for i in range(5)})


@query("d22_salted_views", """
    SELECT us // 3600000000 * 3600 + 3600 AS window_end, COUNT(*) AS cnt FROM ev
    WHERE event_type = 'view' GROUP BY 1""")
def _(spark, sf):
    e = ev(spark, sf).where("event_type = 'view'").select("event_id", "ts")
    out = windows.total_views(e, "ts", "1 hour", "event_id")
    return out.withColumn("window_end", F.unix_seconds("window_end"))


@query("d23_area_city_ad_counts", """
    SELECT strftime(ts, '%Y-%m-%d') AS dt, 'area' || CAST(user_id % 5 AS VARCHAR) AS area,
    'city' || CAST(user_id % 7 AS VARCHAR) AS city, event_type AS ad, COUNT(*) AS cnt FROM ev GROUP BY 1, 2, 3, 4""")
def _(spark, sf):
    good, _bad = lines.parse_delimited(
        ad_lines(spark, sf), " ", "ts long, area string, city string, user string, ad string"
    )
    return agg.count_by(good.withColumn("dt", day_of_millis(F.col("ts"))), ["dt", "area", "city", "ad"])


@query("h14_top_two", """
    WITH r AS (SELECT id, temperature, row_number() OVER (PARTITION BY id ORDER BY temperature DESC, event_id) AS rank
               FROM sensor)
    SELECT id, CAST(rank AS INTEGER) AS rank, temperature FROM r WHERE rank <= 2""")
def _(spark, sf):
    return agg.top_two(tables.sensor(ev(spark, sf)), ["id"], "temperature", "event_id")


@query("h13_average", """
    SELECT id, round(CAST(SUM(CAST(round(temperature * 100) AS BIGINT)) AS DOUBLE) / COUNT(*), 3) AS mean_cents FROM sensor GROUP BY 1""")
def _(spark, sf):
    s = tables.sensor(ev(spark, sf))
    cents = F.round(F.col("temperature") * 100).cast("long")
    return s.groupBy("id").agg(F.round(F.avg(cents), 3).alias("mean_cents"))
