"""Hand-made rows at the exact limits: equal, one unit to either side, ties,
duplicates, single rows, empty input."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalar
from tidemark.operators import aggregates, graph, joins, ordered, patterns, rows, windows
from tidemark.plans import panes

UTC = dt.timezone.utc


def frame(spark, data, ddl="key string, at double, kind string"):
    """Rows get an id in the order given; ``at`` is in seconds."""
    rows_ = [(i, k, float(at), *rest) for i, (k, at, *rest) in enumerate(data)]
    df = spark.createDataFrame(rows_, "id long, " + ddl)
    return df.withColumn("ts", F.timestamp_micros(F.round(F.col("at") * 1_000_000).cast("long")))


def secs(df, *cols):
    return sorted(
        (tuple(r) for r in df.select(*[
            (F.unix_micros(c) / 1e6).alias(c) if dict(df.dtypes)[c] == "timestamp" else F.col(c) for c in cols
        ]).collect()), key=str,
    )


def test_empty_input(spark):
    df = frame(spark, [])
    assert patterns.login_bursts(df, "key", "ts", "id", "kind", 2, "2 seconds").count() == 0
    assert patterns.login_pairs(df, "key", "ts", "id", "kind", "2 seconds").count() == 0
    assert patterns.order_outcomes(df, "key", "ts", "id", "kind", "15 minutes").count() == 0
    assert panes.change_points(df, ["key"], "ts", "1 hour", "5 seconds").count() == 0
    assert windows.sessions(df, ["key"], "ts", "5 seconds", F.lit(1)).count() == 0


@pytest.mark.parametrize("last, hit", [(1.999999, True), (2.0, True), (2.000001, False)])
def test_login_burst_limit_is_inclusive(spark, last, hit):
    df = frame(spark, [("u", 0, "fail"), ("u", 1, "fail"), ("u", last, "fail")])
    got = patterns.login_bursts(df, "key", "ts", "id", "kind", 2, "2 seconds")
    assert secs(got, "key", "first_fail", "last_fail", "fails") == ([("u", 0.0, last, 3)] if hit else [])


def test_login_burst_success_and_order(spark):
    df = frame(spark, [("u", 1, "fail"), ("u", 0, "fail"), ("u", 0.5, "success"), ("u", 1.5, "fail"), ("v", 9, "fail")])
    got = patterns.login_bursts(df, "key", "ts", "id", "kind", 1, "2 seconds")
    assert secs(got, "key", "first_fail", "fails") == [("u", 1.0, 2)]


@pytest.mark.parametrize("gap, hit", [(1.999999, 1), (2.0, 0), (2.000001, 0)])
def test_login_pair_is_strict(spark, gap, hit):
    df = frame(spark, [("u", 100, "fail"), ("u", 100 + gap, "fail")])
    assert patterns.login_pairs(df, "key", "ts", "id", "kind", "2 seconds").count() == hit


def test_strict_sequence(spark):
    df = frame(spark, [("u", t, k) for t, k in [(0, "fail"), (1, "fail"), (2, "fail"), (3, "fail"), (4, "success"), (5, "fail"), (6, "fail"), (7, "success"), (7.5, "fail")]]
               + [("v", 0, "fail"), ("v", 2, "fail"), ("v", 5, "fail"), ("w", 3, "fail"), ("w", 3, "fail"), ("w", 3, "fail")])
    got = patterns.adjacent_run(df, "key", "ts", "id", "kind", ["fail"] * 3, "5 seconds")
    # overlapping matches count; exactly five seconds is too long; equal times are fine
    assert secs(got, "key", "first_at", "last_at") == [("u", 0.0, 2.0), ("u", 1.0, 3.0), ("w", 3.0, 3.0)]


def test_followed_by(spark):
    limit = 15 * 60
    df = frame(spark, [("a", 0, "create"), ("a", 1, "other"), ("a", limit - 0.000001, "pay"), ("b", 0, "create"), ("b", limit, "pay"),
                       ("c", 5, "pay"), ("c", 6, "create"), ("d", 0, "create"), ("d", 1, "create"), ("d", 2, "pay")])
    got = patterns.followed_by(df, "key", "ts", "id", "kind", "create", "pay", "15 minutes")
    assert secs(got, "key", "begin_at", "status") == [
        ("a", 0.0, "pay success"), ("b", 0.0, "timeout"), ("c", 6.0, "timeout"), ("d", 0.0, "pay success"), ("d", 1.0, "pay success")]


def test_approximate_distinct(spark):
    df = spark.range(40_000).select((F.col("id") % 2).alias("w"), (F.col("id") % 17_000).alias("v"))
    got = {r.window_end: r.cnt for r in aggregates.approximate_distinct(df, F.col("w"), F.col("v")).collect()}
    assert set(got) == {0, 1} and all(abs(n - 8_500) < 0.1 * 8_500 for n in got.values())


def test_page_flow_with_a_repeated_start(spark):
    visits = spark.createDataFrame([(1, i, i, p) for i, p in enumerate([1, 2, 1, 3, 1])], "s long, t long, id long, page long")
    visits = visits.withColumn("ts", F.timestamp_seconds("t"))
    got = {(r.from_page, r.to_page): (r.moves, r.visits) for r in ordered.page_flow(visits, "s", "ts", "id", "page", [1, 2, 1, 3, 5]).collect()}
    assert got == {(1, 2): (1, 3), (2, 1): (1, 1), (1, 3): (1, 3)}


def test_order_outcomes(spark):
    limit = 15 * 60
    df = frame(spark, [("ok", 0, "create"), ("ok", limit - 1, "pay"), ("late", 0, "create"), ("late", limit, "pay"),
                       ("early", 0, "pay"), ("early", 1, "create"), ("never", 0, "create"), ("twice", 0, "create"), ("twice", 5, "create"), ("twice", 6, "pay"), ("twice", 7, "pay")])
    got = patterns.order_outcomes(df, "key", "ts", "id", "kind", "15 minutes")
    assert secs(got, "key", "id", "status") == [
        ("early", 4, "paid without create"), ("early", 5, "pay timeout"), ("late", 2, "pay timeout"), ("late", 3, "paid but timed out"),
        ("never", 6, "pay timeout"), ("ok", 1, "pay successfully"), ("twice", 10, "paid without create"),
        ("twice", 7, "pay timeout"), ("twice", 9, "pay successfully")]


def test_click_filter_limit_and_day(spark):
    day = 86400
    clicks = [("u", float(i), "x") for i in range(103)] + [("u", day + i, "x") for i in range(2)] + [("v", 5.0, "x")]
    got = patterns.click_filter(frame(spark, clicks), ["key"], "ts", "id", 100)
    tags = {r.id: r.tag for r in got.collect()}
    assert sum(t == "pass" for t in tags.values()) == 100 + 2 + 1
    assert [i for i, t in tags.items() if t == "warning"] == [100] and 101 not in tags


def test_rise_alert(spark):
    df = frame(spark, [("up", 0, 1.0), ("up", 5, 2.0), ("up", 10, 2.0), ("fall", 0, 1.0), ("fall", 10, 0.5), ("flat", 0, 0.0), ("flat", 3, 0.0),
                       ("again", 0, 1.0), ("again", 10.5, 2.0), ("again", 30, 1.0)], "key string, at double, v double")
    got = patterns.rise_alerts(df, "key", "ts", "id", "v", "10 seconds")
    # a fall at the very deadline still stops the timer
    assert secs(got, "key", "start", "alert_at") == [("again", 0.0, 10.0), ("again", 10.5, 20.5), ("up", 0.0, 10.0)]


def test_jump_alerts(spark):
    df = frame(spark, [("s", 0, 30.0), ("s", 1, 40.0), ("s", 2, 50.5), ("t", 0, 5.0)], "key string, at double, v double")
    got = ordered.jump_alerts(df, "key", "ts", "id", "v", 10.0)
    assert secs(got, "key", "last", "current") == [("s", 40.0, 50.5)]
    got = ordered.jump_alerts(df, "key", "ts", "id", "v", 10.0, first_from_zero=True)
    assert secs(got, "key", "last", "current") == [("s", 0.0, 30.0), ("s", 40.0, 50.5)]


def test_interval_join_bounds(spark):
    left = frame(spark, [("t", 100, "l"), ("u", 7, "l")])
    right = frame(spark, [("t", 100 + d, "r") for d in (-3.000001, -3, 0, 5, 5.000001)] + [("w", 7, "r")])
    got = joins.interval_join(left.drop("at"), right.drop("at"), "key", "ts", "-3 seconds", "5 seconds")
    assert secs(got, "key", "r_ts") == [("t", 100.0), ("t", 105.0), ("t", 97.0)]
    tags = joins.match_with_timeout(left, right, "key", "ts", "5 seconds", "3 seconds")
    assert secs(tags, "key", "tag", "r_id") == [
        ("t", "matched", 1), ("t", "matched", 2), ("t", "matched", 3), ("t", "right_only", 0), ("t", "right_only", 4),
        ("u", "left_only", None), ("w", "right_only", 5)]


def test_one_hot_transaction_is_spread_over_segments(spark):
    left = spark.range(2000).select(F.lit("t").alias("k"), F.timestamp_seconds(F.col("id") * 10).alias("ts"), F.col("id"))
    got = joins.interval_join(left, left, "k", "ts", "-10 seconds", "10 seconds")
    assert got.count() == 3 * 2000 - 2
    assert "_segment" in got._jdf.queryExecution().optimizedPlan().toString()


def test_routing_of_nan_and_null(spark):
    df = spark.createDataFrame([(40.1,), (40.0,), (20.1,), (20.0,), (math.nan,), (None,)], "v double")
    tags = [r.tag for r in rows.route_by_threshold(df, "v", [40.0, 20.0], ["high", "general", "low"]).collect()]
    assert tags == ["high", "general", "general", "low", "low", "low"]


@pytest.mark.parametrize("size, slide", [("1 hour", "5 minutes"), ("9 seconds", "3 seconds"), ("60 seconds", "10 seconds"), ("10 seconds", "10 seconds")])
def test_panes_equal_builtin_window(spark, size, slide):
    df = frame(spark, [("ab"[i % 2], (i * i * 7) % 5000, "x") for i in range(150)] + [("a", -13.0, "x")])
    want = df.groupBy("key", F.window("ts", size, slide).end.alias("window_end")).agg(F.count("*").alias("cnt"))
    assert secs(panes.sliding(df, ["key"], "ts", size, slide), "key", "window_end", "cnt") == secs(want, "key", "window_end", "cnt")
    steps = panes.change_points(df, ["key"], "ts", size, slide)
    assert secs(panes.expand_change_points(steps, slide), "key", "window_end", "cnt") == secs(want, "key", "window_end", "cnt")


def test_pane_size_must_fit(spark):
    with pytest.raises(ValueError):
        panes.sliding(frame(spark, []), ["key"], "ts", "10 seconds", "3 seconds")


def test_sessions_equal_builtin(spark):
    df = frame(spark, [("a", t, "x") for t in (0, 5, 10.000001, 15, 15, 100, 104.9, 109.8)] + [("b", 3, "x")])
    got = windows.sessions(df, ["key"], "ts", "5 seconds", F.col("id"))
    want = df.groupBy("key", F.session_window("ts", "5 seconds").alias("w")).agg(F.count("*").alias("cnt"), F.sum("id").alias("total"))
    assert secs(got, "key", "session_start", "session_end", "cnt", "total") == secs(
        want.select("key", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "cnt", "total"),
        "key", "session_start", "session_end", "cnt", "total")


def test_page_flow_denominator_counts_all_visits(spark):
    df = frame(spark, [("s", 0, 1), ("s", 1, 2), ("s", 2, 1), ("s", 3, 3), ("s", 4, 1), ("t", 0, 1)], "key string, at double, page int")
    got = ordered.page_flow(df, "key", "ts", "id", "page", [1, 2, 3])
    assert secs(got, "from_page", "to_page", "moves", "visits", "conversion") == [(1, 2, 1, 4, 0.25)]


def test_rolling_rows(spark):
    df = frame(spark, [("s", i, float(i)) for i in range(5)], "key string, at double, v double")
    got = ordered.rolling_rows(df, ["key"], "ts", "id", "v", 2)
    assert secs(got, "id", "cnt", "mean") == [(0, 1, 0.0), (1, 2, 0.5), (2, 3, 1.0), (3, 3, 2.0), (4, 3, 3.0)]


def java_hash(s: str, factor: int) -> int:
    units = s.encode("utf-16-be")
    h = 0
    for i in range(0, len(units), 2):
        h = (h * factor + int.from_bytes(units[i:i + 2], "big")) & 0xFFFFFFFF
    return h


def test_hashes(spark):
    words = ["", "a", "hello", "sensor_1", "传感器", "a😀b", "x" * 200]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = df.select("w", scalar.hash_code(F.col("w"), 23).alias("c"), scalar.bitmap_offset(F.col("w")).alias("p")).collect()
    for r in got:
        code = (java_hash(r.w, 31) * 23 - 10000) & 0xFFFFFFFF
        assert r.c == (code - (1 << 32) if code >= 1 << 31 else code), r.w
        assert r.p == java_hash(r.w, 61) & ((1 << 29) - 1), r.w


def test_integer_mean_truncates_and_skips_null(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", None), ("b", None), ("c", -3), ("c", 0)], "k string, v int")
    got = {r.k: r.m for r in df.groupBy("k").agg(scalar.integer_mean(F.col("v")).alias("m")).collect()}
    assert got == {"a": 1, "b": None, "c": -1}


def test_top_two(spark):
    df = frame(spark, [("a", 0, 3.0), ("a", 1, 3.0), ("a", 2, 1.0), ("b", 0, 9.0)], "key string, at double, v double")
    assert secs(aggregates.top_two(df, ["key"], "v", "id"), "key", "rank", "v") == [("a", 1, 3.0), ("a", 2, 3.0), ("b", 1, 9.0), ("b", 2, None)]
    low = aggregates.top_two(df, ["key"], "v", "id", sentinel=-1.0)
    assert ("b", 2, -1.0) in secs(low, "key", "rank", "v")


def test_category_counts_and_missing(spark):
    df = spark.createDataFrame([("1", "null", "null"), ("-1", "1,2", "null"), ("-1", "null", "2,2"), ("3", "4", "5"), (None, None, None)], "c string, o string, p string")
    add = aggregates.category_counts(df, "c", "o", "p")
    assert secs(add, "category_id", "clicks", "orders", "pays") == [("1", 1, 1, 0), ("2", 0, 1, 2), ("3", 1, 0, 0), ("4", 0, 1, 0), ("5", 0, 0, 1)]
    one = aggregates.category_counts(df, "c", "o", "p", exclusive=True)
    assert secs(one, "category_id", "clicks", "orders", "pays") == [("1", 1, 1, 0), ("2", 0, 1, 2), ("3", 1, 0, 0)]


def test_top_n_ties(spark):
    df = spark.createDataFrame([("g", i, 5) for i in range(10)], "g string, item int, n int")
    got = aggregates.top_n_per_group(df, ["g"], [F.desc("n"), F.asc("item")], 3)
    assert sorted(r.item for r in got.collect()) == [0, 1, 2]


def test_two_rule_fold(spark):
    df = spark.createDataFrame([("a", 0, 1), ("a", 0, 2), ("a", 1, 3), ("a", 1, 4)], "k string, part int, v int")
    assert aggregates.two_rule_fold(df, ["k"], "part", "v").first().total == 6


def test_salted_count_is_stable(spark):
    df = spark.range(1000).select("id", F.lit("hot").alias("k"))
    for parts in (1, 7):
        assert aggregates.salted_count(df.repartition(parts), ["k"], "id").first().cnt == 1000


def test_graph(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (4, 4)], "src int, dst int")
    size = graph.graph_size(edges).first()
    assert (size.vertices, size.edges) == (4, 4)
    assert sorted(map(tuple, graph.adjacency(edges).collect())) == [(1, 2), (2, 1), (2, 3), (3, 2), (4, 4)]
    assert [r.neighbour for r in graph.neighbours(edges, 2).orderBy("neighbour").collect()] == [1, 3]
    asked = spark.createDataFrame([(3, 2), (1, 3)], "a int, b int")
    assert list(map(tuple, graph.has_edges(asked, edges).collect())) == [(3, 2)]


def test_results_do_not_depend_on_partitions(spark):
    df = frame(spark, [("ab"[i % 2], (i * 37) % 90, "fail" if i % 4 else "success") for i in range(80)])
    seen = set()
    for n in (1, 3, 11):
        mixed = df.repartition(n, F.hash("id"))
        seen.add(str([
            secs(patterns.login_bursts(mixed, "key", "ts", "id", "kind", 1, "10 seconds"), "key", "first_fail", "fails"),
            secs(patterns.login_pairs(mixed, "key", "ts", "id", "kind", "5 seconds"), "key", "first_at", "last_at"),
            secs(windows.sessions(mixed, ["key"], "ts", "2 seconds", F.col("id")), "key", "session_start", "total"),
        ]))
    assert len(seen) == 1


def test_edges_are_not_listed_in_both_directions(spark):
    """Asked pairs meet the edges as they are given, without a table of distinct neighbours."""
    edges = spark.createDataFrame([(1, 2), (1, 2), (3, 2), (4, 4), (None, 5), (5, None), (None, None)], "src int, dst int")
    asked = spark.createDataFrame([(2, 1), (2, 1), (4, 4), (5, 5), (None, 5), (5, None), (None, None), (1, 3)], "a int, b int")
    got = graph.has_edges(asked, edges)
    assert sorted(map(tuple, got.collect())) == [(2, 1), (2, 1), (4, 4)]
    assert "Aggregate" not in got._jdf.queryExecution().optimizedPlan().toString()
