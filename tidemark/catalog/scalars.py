"""Scalar and table functions, and the graph operators, over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.functions import scalar, tabular
from tidemark.operators import graph, windows
from tidemark.sources import tables

ev = tables.events


@query("h1_string_functions", """
    SELECT c_custkey, string_split(c_name, '#')[2] AS part, length(c_name) AS len,
    c_mktsegment || '-' || c_name AS joined, c_mktsegment = 'BUILDING' AS building FROM customer""")
def _(spark, sf):
    c = tables.table(spark, sf, "customer")
    return c.select(
        "c_custkey", F.split("c_name", "#")[1].alias("part"), F.length("c_name").cast("long").alias("len"),
        F.concat_ws("-", "c_mktsegment", "c_name").alias("joined"), (F.col("c_mktsegment") == "BUILDING").alias("building"),
    )


_FOLD = """list_reduce(list_prepend(0::BIGINT, list_transform(string_split({s}, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, c: (a * {m} + c) % 4294967296)"""


@query("h2_hash_code", f"""
    WITH h AS (SELECT event_id, ({_FOLD.format(s='event_type', m=31)} * 23 - 10000) AS v FROM events),
    w AS (SELECT event_id, ((v % 4294967296) + 4294967296) % 4294967296 AS v FROM h)
    SELECT event_id, CASE WHEN v >= 2147483648 THEN v - 4294967296 ELSE v END AS code FROM w""")
def _(spark, sf):
    return ev(spark, sf).select("event_id", scalar.hash_code(F.col("event_type"), 23).alias("code"))


@query("h3_bitmap_hash", f"""
    SELECT c_custkey, {_FOLD.format(s='c_name', m=61)} & 536870911 AS position FROM customer""")
def _(spark, sf):
    c = tables.table(spark, sf, "customer")
    return c.select("c_custkey", scalar.bitmap_offset(F.col("c_name")).alias("position"))


@query("h4_h5_h6_time_parts", """
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%M:%S') AS minute_second,
    us // 1000 // 10000 * 10000 AS bucket FROM ev""")
def _(spark, sf):
    ms = F.unix_millis("ts")
    return ev(spark, sf).select(
        "event_id", scalar.day_of_millis(ms).alias("day"), scalar.minute_second(ms).alias("minute_second"),
        scalar.floor_to(ms, 10000).alias("bucket"),
    )


@query("h7_parse_time", "SELECT event_id, us // 1000000 AS at FROM ev")
def _(spark, sf):
    e = ev(spark, sf)
    text = F.date_format("ts", "dd/MM/yyyy:HH:mm:ss")
    return e.select("event_id", F.unix_seconds(scalar.web_log_time(text)).alias("at"))


@query("h8_absolute_difference", "SELECT event_id, abs(user_id - k) AS diff FROM ev")
def _(spark, sf):
    b = tables.behaviour(ev(spark, sf))
    return b.select("event_id", scalar.absolute_difference(F.col("user_id"), F.col("item_id")).alias("diff"))


@query("h9_month_year_or_zero", """
    SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(year(o_orderdate) AS INTEGER) AS y,
    CASE WHEN n_regionkey IS NULL THEN 0 ELSE n_regionkey END AS region
    FROM orders LEFT JOIN nation ON o_custkey = n_nationkey""")
def _(spark, sf):
    o = tables.table(spark, sf, "orders")
    n = tables.table(spark, sf, "nation")
    joined = o.join(n, F.col("o_custkey") == F.col("n_nationkey"), "left")
    return joined.select(
        "o_orderkey", F.month("o_orderdate").alias("m"), F.year("o_orderdate").alias("y"),
        scalar.or_zero(F.col("n_regionkey")).alias("region"),
    )


@query("h10_window_ends", """
    SELECT event_id, us // 10000000 * 10 + 10 AS tumble_end, us // 300000000 * 300 + 300 AS first_hop_end,
    us // 300000000 * 300 + 3600 AS last_hop_end FROM ev""")
def _(spark, sf):
    first = windows.window_end("ts", "5 minutes")
    return ev(spark, sf).select(
        "event_id", F.unix_seconds(windows.window_end("ts", "10 seconds")).alias("tumble_end"),
        F.unix_seconds(first).alias("first_hop_end"),
        F.unix_seconds(first + F.expr("INTERVAL 55 MINUTES")).alias("last_hop_end"),
    )


@query("h11_prefix_name", "SELECT c_custkey, 'Name: ' || c_name AS name FROM customer")
def _(spark, sf):
    c = tables.table(spark, sf, "customer")
    return c.select("c_custkey", scalar.prefix_name(F.col("c_name")).alias("name"))


@query("h11_prefix_name_udf", "SELECT c_custkey, 'Name: ' || c_name AS name FROM customer")
def _(spark, sf):
    tabular.register(spark)
    tables.table(spark, sf, "customer").createOrReplaceTempView("customer_named")
    return spark.sql("SELECT c_custkey, prefix_name(c_name) AS name FROM customer_named")


@query("h12_integer_mean", """
    SELECT c_mktsegment, CAST(SUM(c_nationkey) AS BIGINT) // COUNT(*) AS mean FROM customer GROUP BY 1""")
def _(spark, sf):
    c = tables.table(spark, sf, "customer")
    return c.groupBy("c_mktsegment").agg(scalar.integer_mean(F.col("c_nationkey")).alias("mean"))


@query("h15_split_udtf", """
    SELECT c_custkey, word, CAST(length(word) AS INTEGER) AS len FROM
    (SELECT c_custkey, unnest(string_split(c_name, '#')) AS word FROM customer) WHERE word <> ''""")
def _(spark, sf):
    tabular.register(spark)
    tables.table(spark, sf, "customer").createOrReplaceTempView("customer_named")
    return spark.sql("SELECT c_custkey, word, len FROM customer_named, LATERAL split_words(c_name, '#')")


def part_supplier_edges(spark, sf):
    """Parts and suppliers as vertices of one graph (suppliers get negative ids)."""
    li = tables.table(spark, sf, "lineitem")
    return li.select(F.col("l_partkey").alias("src"), (-F.col("l_suppkey") - 1).alias("dst"))


_EDGES = "(SELECT l_partkey AS src, -l_suppkey - 1 AS dst FROM lineitem)"
_BOTH = f"(SELECT src AS vertex, dst AS neighbour FROM {_EDGES} UNION SELECT dst, src FROM {_EDGES})"


@query("h16_graph_size", f"""
    SELECT (SELECT COUNT(DISTINCT vertex) FROM {_BOTH}) AS vertices, (SELECT COUNT(*) FROM lineitem) AS edges""")
def _(spark, sf):
    return graph.graph_size(part_supplier_edges(spark, sf))


@query("h16_adjacency", f"SELECT vertex, neighbour FROM {_BOTH}")
def _(spark, sf):
    return graph.adjacency(part_supplier_edges(spark, sf))


@query("h16_neighbours", f"SELECT neighbour FROM {_BOTH} WHERE vertex = 7")
def _(spark, sf):
    return graph.neighbours(part_supplier_edges(spark, sf), 7)


@query("h16_has_edges", f"""
    SELECT a, b FROM (SELECT p_partkey AS a, -(p_partkey % 10) - 1 AS b FROM part) q
    WHERE EXISTS (SELECT 1 FROM {_BOTH} g WHERE g.vertex = a AND g.neighbour = b)""")
def _(spark, sf):
    asked = tables.table(spark, sf, "part").select(
        F.col("p_partkey").alias("a"), (-(F.col("p_partkey") % 10) - 1).alias("b")
    )
    return graph.has_edges(asked, part_supplier_edges(spark, sf))
