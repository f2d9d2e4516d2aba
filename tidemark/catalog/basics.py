"""Sources, projections and joins over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import query, us
from tidemark.operators import joins, rows
from tidemark.session import scratch_dir
from tidemark.sources import files, lines, tables, topics

ev = tables.events


# --- A: sources -------------------------------------------------------------

@query("a1_text_lines", """
    SELECT line AS value, COUNT(*) AS cnt
    FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY line""")
def _(spark, sf):
    path = scratch_dir(spark, "text")
    docs = tables.table(spark, sf, "documents")
    files.write_text(docs.select(F.explode(F.split("text", "\n")).alias("value")), path)
    lines_read = files.text_lines(spark, path)
    return lines_read.groupBy("value").agg(F.count("*").alias("cnt"))


@query("a3_csv_schema", "SELECT event_id, user_id, event_type, value FROM events")
def _(spark, sf):
    path = scratch_dir(spark, "csv")
    files.write_csv(ev(spark, sf).select("event_id", "user_id", "event_type", "value"), path)
    return files.csv(spark, path, "event_id long, user_id long, event_type string, value double")


_AD_LINES = """CAST(us // 1000 AS VARCHAR) || ' area' || CAST(user_id % 5 AS VARCHAR) || ' city'
    || CAST(user_id % 7 AS VARCHAR) || ' ' || CAST(user_id AS VARCHAR) || ' ' || event_type"""


def ad_lines(spark, sf):
    e = ev(spark, sf)
    return e.select(F.concat_ws(
        " ", F.unix_millis("ts").cast("string"),
        F.concat(F.lit("area"), (F.col("user_id") % 5).cast("string")),
        F.concat(F.lit("city"), (F.col("user_id") % 7).cast("string")),
        F.col("user_id").cast("string"), "event_type",
    ).alias("value"))


@query("a4_parse_delimited", f"""
    SELECT CAST(string_split(v, ' ')[1] AS BIGINT) AS ts, string_split(v, ' ')[2] AS area,
           string_split(v, ' ')[3] AS city, CAST(string_split(v, ' ')[4] AS BIGINT) AS user_id,
           string_split(v, ' ')[5] AS ad
    FROM (SELECT {_AD_LINES} AS v FROM ev)""")
def _(spark, sf):
    good, _bad = lines.parse_delimited(
        ad_lines(spark, sf), " ", "ts long, area string, city string, user_id long, ad string"
    )
    return good


@query("a4_bad_lines", "SELECT text AS value FROM documents WHERE trim(text) <> ''")
def _(spark, sf):
    docs = tables.table(spark, sf, "documents").select(F.col("text").alias("value"))
    _good, bad = lines.parse_delimited(docs, ",", "user_id long, ad_id long, province string, ts long")
    return bad


@query("a5_web_log_lines", """
    SELECT '10.0.0.' || CAST(user_id % 200 AS VARCHAR) AS ip, '-' AS user_id,
           (us // 1000000) AS ts, CASE WHEN event_type = 'view' THEN 'GET' ELSE 'POST' END AS method,
           '/page/' || CAST(k % 15 AS VARCHAR) AS url FROM ev""")
def _(spark, sf):
    e = ev(spark, sf)
    line = F.concat_ws(
        " ", F.concat(F.lit("10.0.0."), (F.col("user_id") % 200).cast("string")), F.lit("-"), F.lit("-"),
        F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"),
        F.when(F.col("event_type") == "view", "GET").otherwise("POST"),
        F.concat(F.lit("/page/"), (F.regexp_extract("props", "[0-9]+", 0).cast("long") % 15).cast("string")),
    )
    parsed = lines.parse_web_log(e.select(F.concat(line, F.lit("\r")).alias("value")))
    return parsed.withColumn("ts", F.unix_seconds("ts"))


@query("a6_json_inferred", "SELECT event_id, event_type, value FROM events")
def _(spark, sf):
    path = scratch_dir(spark, "json")
    ev(spark, sf).select("event_id", "event_type", "value").write.json(path)
    return files.json(spark, path).select("event_id", "event_type", "value")


@query("a13_topic_payload", """
    SELECT CAST(event_id AS VARCHAR) || ',' || event_type || ',' || CAST(user_id AS VARCHAR) AS value
    FROM events WHERE event_type <> 'error'""")
def _(spark, sf):
    """Topic → filter → topic, up to the message bodies."""
    sent = topics.encode(ev(spark, sf).select("event_id", "event_type", "user_id"))
    messages = sent.select(F.col("value").cast("binary").alias("value"))
    good, _bad = topics.decode(messages, ",", "event_id long, event_type string, user_id long")
    return topics.encode(good.where("event_type <> 'error'"))


@query("a19_series_json", """
    SELECT '[' || string_agg('{"xtime":"' || strftime(b, '%M:%S') || '","yval":"' || CAST(n AS VARCHAR)
           || '"}', ',' ORDER BY b) || ']' AS series
    FROM (SELECT date_trunc('day', ts) AS b, COUNT(*) AS n FROM events GROUP BY 1)""")
def _(spark, sf):
    daily = ev(spark, sf).groupBy(F.date_trunc("day", "ts").alias("b")).agg(F.count("*").alias("n"))
    return files.series_json(daily, "b", "n")


# --- B: projections, filters, routing ---------------------------------------

@query("b1_projection", "SELECT id, temperature FROM sensor")
def _(spark, sf):
    return tables.sensor(ev(spark, sf)).select("id", "temperature")


@query("b2_filter", "SELECT event_id, id FROM sensor WHERE id = 'ws_1' OR temperature <> 0.01 AND id <> 'ws_2'")
def _(spark, sf):
    s = tables.sensor(ev(spark, sf))
    keep = (F.col("id") == "ws_1") | ((F.col("temperature") != 0.01) & (F.col("id") != "ws_2"))
    return s.where(keep).select("event_id", "id")


@query("b3_arithmetic", "SELECT c_custkey, c_nationkey + 1 AS next_nation FROM customer")
def _(spark, sf):
    c = tables.table(spark, sf, "customer")
    return c.select("c_custkey", (F.col("c_nationkey") + 1).alias("next_nation"))


@query("b4_sql_text", "SELECT behaviour, COUNT(*) AS cnt FROM behaviour WHERE behaviour <> 'error' GROUP BY behaviour")
def _(spark, sf):
    return rows.run_sql(
        tables.behaviour(ev(spark, sf)), "behaviour_log",
        "SELECT behaviour, count(*) AS cnt FROM behaviour_log WHERE behaviour <> 'error' GROUP BY behaviour",
    )


@query("b5_tokens", """
    SELECT word, COUNT(*) AS cnt FROM (SELECT unnest(regexp_split_to_array(text, '[^a-zA-Z0-9_]+')) AS word
    FROM documents) WHERE word <> '' GROUP BY word""")
def _(spark, sf):
    pieces = rows.tokens(tables.table(spark, sf, "documents"), "text", "\\W+")
    return pieces.groupBy("word").agg(F.count("*").alias("cnt"))


@query("b6_parse_and_keep", """
    SELECT event_id AS id, k AS item, us AS at FROM ev WHERE event_type = 'purchase'""")
def _(spark, sf):
    b = tables.behaviour(ev(spark, sf))
    return rows.keep_parsed(
        b, F.col("behaviour") == "purchase", id=F.col("event_id"), item=F.col("item_id"), at=us("ts")
    )


@query("b7_partial_collect", """
    SELECT click_category_id || '_' || session_id AS pair FROM visit
    WHERE click_category_id IS NOT NULL AND page_id < 4""")
def _(spark, sf):
    v = tables.visits(ev(spark, sf))
    return rows.keep_parsed(
        v, F.col("click_category_id").isNotNull() & (F.col("page_id") < 4),
        pair=F.concat_ws("_", "click_category_id", "session_id"),
    )


@query("b8_route", """
    SELECT event_id, CASE WHEN temperature > 40 THEN 'high' WHEN temperature > 20 THEN 'general'
    ELSE 'low' END AS tag FROM sensor""")
def _(spark, sf):
    routed = rows.route_by_threshold(
        tables.sensor(ev(spark, sf)), "temperature", [40.0, 20.0], ["high", "general", "low"]
    )
    return routed.select("event_id", "tag")


@query("b9_match_mapping", """
    SELECT CASE WHEN behaviour = 'pv' THEN CAST(user_id AS VARCHAR) ELSE '' END AS "user",
    CAST(SUM(CASE WHEN behaviour = 'pv' THEN 1 ELSE 0 END) AS BIGINT) AS cnt FROM behaviour GROUP BY 1""")
def _(spark, sf):
    b = tables.behaviour(ev(spark, sf))
    return rows.sum_of_matches(
        b, F.col("behaviour") == "pv", F.col("user_id").cast("string"), F.lit(""), "user"
    )


@query("b11_per_partition", "SELECT event_id, user_id * 2 AS twice FROM events")
def _(spark, sf):
    def double(batches):
        for pdf in batches:
            yield pdf.assign(twice=pdf["user_id"] * 2)[["event_id", "twice"]]

    return rows.per_partition(ev(spark, sf).select("event_id", "user_id"), double, "event_id long, twice long")


@query("b14_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def _(spark, sf):
    return ev(spark, sf).select("user_id", "event_type").distinct()


@query("b18_union", """
    SELECT user_id, behaviour AS kind FROM behaviour UNION ALL SELECT user_id, event_type AS kind FROM login""")
def _(spark, sf):
    e = ev(spark, sf)
    return rows.union_all(
        tables.behaviour(e).select("user_id", F.col("behaviour").alias("kind")),
        tables.logins(e).select("user_id", F.col("event_type").alias("kind")),
    )


@query("b19_sort_take", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def _(spark, sf):
    o = tables.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return rows.top_rows(o, [F.desc("o_totalprice"), F.asc("o_orderkey")], 10)


# --- C: joins ----------------------------------------------------------------

@query("c1_inner_join", """
    SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(spark, sf):
    o = tables.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = tables.table(spark, sf, "customer").select("c_custkey", "c_name")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("c2_lookup_default", """
    SELECT event_id, e.user_id, COALESCE(n.n_regionkey, 0) AS n_regionkey
    FROM events e LEFT JOIN nation n ON e.user_id = n.n_nationkey""")
def _(spark, sf):
    e = ev(spark, sf).select("event_id", "user_id")
    dim = tables.table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("long").alias("user_id"), "n_regionkey"
    )
    return joins.lookup(e, dim, "user_id", "n_regionkey", 0)


@query("c3_cogroup_sums", """
    SELECT user_id, CAST(COALESCE(SUM(CASE WHEN event_type = 'click' THEN 1 END), 0) AS BIGINT) AS clicks,
    CAST(COALESCE(SUM(CASE WHEN event_type = 'signup' THEN k END), 0) AS BIGINT) AS orders,
    CAST(COALESCE(SUM(CASE WHEN event_type = 'purchase' THEN k END), 0) AS BIGINT) AS pays
    FROM ev WHERE event_type IN ('click', 'signup', 'purchase') GROUP BY user_id""")
def _(spark, sf):
    b = tables.behaviour(ev(spark, sf))
    side = lambda kind: b.where(F.col("behaviour") == kind)
    return joins.cogroup_sums(
        "user_id", clicks=(side("click"), F.lit(1)), orders=(side("signup"), F.col("item_id")),
        pays=(side("purchase"), F.col("item_id")),
    )


INTERVAL_SQL = """
    SELECT o.tx_id, o.order_id, r.channel, o.us AS paid_at, r.us AS received_at
    FROM order_event o JOIN receipt r ON o.tx_id = r.tx_id
    AND r.us BETWEEN o.us - 3000000 AND o.us + 5000000"""


@query("c5_interval_join", INTERVAL_SQL)
def _(spark, sf):
    e = ev(spark, sf)
    pays = tables.order_events(e).where("event_type = 'pay'")
    pairs = joins.interval_join(pays, tables.receipts(e), "tx_id", "ts", "-3 seconds", "5 seconds")
    return pairs.select(
        "tx_id", F.col("l_order_id").alias("order_id"), F.col("r_channel").alias("channel"),
        us("l_ts", "paid_at"), us("r_ts", "received_at"),
    )


TIMEOUT_SQL = """
    WITH o AS (SELECT * FROM order_event WHERE event_type = 'pay')
    SELECT COALESCE(o.tx_id, r.tx_id) AS tx_id, o.us AS paid_at, r.us AS received_at,
    CASE WHEN r.tx_id IS NULL THEN 'left_only' WHEN o.tx_id IS NULL THEN 'right_only' ELSE 'matched' END AS tag
    FROM o FULL JOIN receipt r ON o.tx_id = r.tx_id AND r.us BETWEEN o.us - 3000000 AND o.us + 5000000"""


@query("c6_match_with_timeout", TIMEOUT_SQL)
def _(spark, sf):
    e = ev(spark, sf)
    pays = tables.order_events(e).where("event_type = 'pay'")
    out = joins.match_with_timeout(pays, tables.receipts(e), "tx_id", "ts", "5 seconds", "3 seconds")
    return out.select("tx_id", us("l_ts", "paid_at"), us("r_ts", "received_at"), "tag")


LATEST_SQL = """
    WITH c AS (SELECT order_id, event_id, us, row_number() OVER (PARTITION BY order_id ORDER BY us DESC, event_id DESC) AS rn
               FROM order_event WHERE event_type = 'create'),
         p AS (SELECT order_id, event_id, us, row_number() OVER (PARTITION BY order_id ORDER BY us DESC, event_id DESC) AS rn
               FROM order_event WHERE event_type = 'pay')
    SELECT c.order_id, c.event_id AS create_id, p.event_id AS pay_id
    FROM c JOIN p ON c.order_id = p.order_id AND c.rn = 1 AND p.rn = 1"""


@query("c7_latest_pairs", LATEST_SQL)
def _(spark, sf):
    o = tables.order_events(ev(spark, sf)).select("order_id", "event_id", "event_type", "ts")
    pairs = joins.latest_pairs(
        o.where("event_type = 'create'"), o.where("event_type = 'pay'"), "order_id", "ts", "event_id"
    )
    return pairs.select("order_id", F.col("l_event_id").alias("create_id"), F.col("r_event_id").alias("pay_id"))


@query("c8_anti_join", """
    SELECT event_id, user_id FROM ad_click WHERE user_id NOT IN
    (SELECT user_id FROM ad_click GROUP BY user_id HAVING COUNT(*) >= 15)""")
def _(spark, sf):
    clicks = tables.ad_clicks(ev(spark, sf)).select("event_id", "user_id")
    listed = clicks.groupBy("user_id").count().where("count >= 15")
    return joins.without_listed(clicks, listed, "user_id")


@query("c9_lateral_split", """
    SELECT doc_id, word, length(word) AS len FROM
    (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) WHERE word <> ''""")
def _(spark, sf):
    docs = tables.table(spark, sf, "documents").select("doc_id", "text")
    from tidemark.functions.tabular import split_words

    return split_words(docs, "text", " ").select("doc_id", "word", "len")


@query("c10_semi_join_top", """
    SELECT event_id, item_id FROM behaviour WHERE item_id IN
    (SELECT item_id FROM behaviour GROUP BY item_id ORDER BY COUNT(*) DESC, item_id LIMIT 10)""")
def _(spark, sf):
    b = tables.behaviour(ev(spark, sf)).select("event_id", "item_id")
    top = rows.top_rows(
        b.groupBy("item_id").agg(F.count("*").alias("n")), [F.desc("n"), F.asc("item_id")], 10
    )
    return joins.only_listed(b, F.broadcast(top), "item_id")


@query("c11_join_filter_limit", """
    SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS qty FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    WHERE o_orderstatus = 'O' AND l_returnflag = 'N'
    ORDER BY o_orderkey DESC, l_linenumber, l_partkey, l_suppkey, l_quantity LIMIT 10""")
def _(spark, sf):
    o = tables.table(spark, sf, "orders").where("o_orderstatus = 'O'").select("o_orderkey")
    li = tables.table(spark, sf, "lineitem").where("l_returnflag = 'N'").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long").alias("qty")
    )
    joined = o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey")
    order = [F.desc("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "qty"]
    return joined.orderBy(*order).limit(10)


@query("c11_in_subquery_limit", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_orderkey IN
    (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'N') ORDER BY o_orderkey DESC LIMIT 10""")
def _(spark, sf):
    o = tables.table(spark, sf, "orders").where("o_orderstatus = 'O'").select("o_orderkey", "o_custkey")
    li = tables.table(spark, sf, "lineitem").where("l_returnflag = 'N'")
    return joins.only_listed(o, li.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey").orderBy(
        F.desc("o_orderkey")
    ).limit(10)


_MONTHS = ", ".join(
    f"COALESCE(SUM(CASE WHEN month(o_orderdate) = {m} THEN cents END), 0)::BIGINT AS m{m:02d}"
    for m in range(1, 13)
)


@query("c12_month_totals", f"""
    WITH o AS (SELECT o_custkey, o_orderdate, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders
               WHERE o_orderstatus = 'F' AND year(o_orderdate) = 1997)
    SELECT c_custkey, c_name, {_MONTHS}, COALESCE(SUM(cents), 0)::BIGINT AS year_total
    FROM customer LEFT JOIN o ON c_custkey = o_custkey GROUP BY c_custkey, c_name""")
def _(spark, sf):
    o = tables.table(spark, sf, "orders").where(
        "o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP_NTZ'1997-01-01' AND o_orderdate < TIMESTAMP_NTZ'1998-01-01'"
    ).withColumnRenamed("o_custkey", "c_custkey")
    c = tables.table(spark, sf, "customer").select("c_custkey", "c_name")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return joins.month_totals(c, o, "c_custkey", "o_orderdate", cents)
