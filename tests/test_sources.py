"""Sources, sinks and partition control that have no result table of their own."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions import tabular
from tidemark.operators import aggregates, rows
from tidemark.session import scratch_dir
from tidemark.sources import files, jdbc, lines, topics
from tidemark.streaming import runner


def test_whole_files_and_lines(spark, tmp_path):
    (tmp_path / "t").mkdir()
    for name in ("a", "b"):
        (tmp_path / "t" / name).write_text(f"{name} one\n{name} two\n")
    path = str(tmp_path / "t")
    assert files.text_lines(spark, path).count() == 4
    assert sorted(r.value for r in files.whole_files(spark, path).collect()) == ["a one\na two\n", "b one\nb two\n"]
    got = runner.run_append(files.line_stream(spark, path), "lines")
    assert got.count() == 4


def test_one_text_file_per_partition(spark, tmp_path):
    out = str(tmp_path / "out")
    files.write_text(spark.range(30).repartition(3).select(F.col("id").alias("value")), out)
    assert len([f for f in os.listdir(out) if f.startswith("part-")]) == 3
    assert spark.read.text(out).count() == 30


def test_csv_stream(spark, tmp_path):
    out = str(tmp_path / "csv")
    files.write_csv(spark.createDataFrame([("ws_1", 1.5)], "id string, t double"), out)
    got = runner.run_append(files.csv_stream(spark, out, "id string, t double"), "csv")
    assert [tuple(r) for r in got.collect()] == [("ws_1", 1.5)]


def test_bad_lines_are_kept(spark):
    text = ["1,create,,100", "2,pay,tx,101\r", "x,pay,tx,102", "3,pay,tx", "", "4,pay,tx,103,more"]
    df = spark.createDataFrame([(t,) for t in text], "value string")
    good, bad = lines.parse_delimited(df, ",", "order_id long, kind string, tx string, ts long")
    assert sorted(map(tuple, good.collect())) == [(1, "create", "", 100), (2, "pay", "tx", 101)]
    assert sorted(r.value for r in bad.collect()) == ["3,pay,tx", "4,pay,tx,103,more", "x,pay,tx,102"]


def test_visit_lines(spark):
    row = "2024-01-01_7_s1_3_2024-01-01 10:00:00_null_-1_-1_1,2_5_null_null_9"
    df = spark.createDataFrame([(row,)], "value string")
    good, _ = lines.parse_delimited(df, "_", lines.VISIT_SCHEMA)
    r = lines.missing_to_null(good).first()
    assert (r.user_id, r.page_id, r.click_category_id, r.order_category_ids, r.pay_category_ids, r.city_id) == (7, 3, None, "1,2", None, 9)


def test_web_log_lines(spark):
    text = ["10.0.0.1 - - 17/05/2015:10:05:03 +0000 GET /a?b=1\r", "", "broken line", "10.0.0.2 u - 99/05/2015:10:05:03 +0000 GET /x"]
    got = lines.parse_web_log(spark.createDataFrame([(t,) for t in text], "value string"))
    assert [(r.ip, r.url, r.s) for r in got.select("ip", "url", F.unix_seconds("ts").alias("s")).collect()] == [("10.0.0.1", "/a?b=1", 1431857103)]


def test_jdbc_options():
    got = jdbc.read_options("jdbc:x:y", "t", "id", 0, 100, 8, user="u")
    assert got == {"url": "jdbc:x:y", "dbtable": "t", "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "8", "user": "u"}
    with pytest.raises(ValueError):
        jdbc.read_options("jdbc:x:y", "t", "id")


def test_topic_payload_round_trip(spark):
    df = spark.createDataFrame([(1, "a", 2.5), (2, None, None)], "id long, s string, v double")
    messages = topics.encode(df).select(F.col("value").cast("binary").alias("value"))
    good, bad = topics.decode(messages, ",", "id long, s string, v double")
    assert sorted(map(tuple, good.collect())) == [(1, "a", 2.5), (2, "", None)] and bad.count() == 0


def test_printing(spark, tmp_path, capsys):
    df = spark.createDataFrame([("ws_1", 1.5)], "id string, t double")
    files.print_rows(df)
    assert "ws_1" in capsys.readouterr().out
    files.write_csv(df, str(tmp_path / "csv"))
    stream = files.csv_stream(spark, str(tmp_path / "csv"), "id string, t double")
    query = files.print_stream(stream, str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None


def test_catalog_listing(spark):
    spark.range(1).createOrReplaceTempView("listed_view")
    assert "listed_view" in {r.tableName for r in files.tables(spark).collect()}


def test_partition_control(spark):
    df = spark.range(0, 100, 1, 8)
    assert rows.set_partitions(df, 3, shuffle=False).rdd.getNumPartitions() == 3
    assert rows.set_partitions(df, 5, shuffle=True).rdd.getNumPartitions() == 5
    keyed = rows.with_partition_index(rows.set_partitions(df.withColumn("k", F.col("id") % 3), 4, True, ["k"]))
    assert keyed.groupBy("k").agg(F.count_distinct("part").alias("n")).agg(F.max("n")).first()[0] == 1
    parts = rows.with_partition_index(df).where("part = 2").select("id")
    assert rows.keep_partition(df, 2).collect() == parts.collect()


def test_sample_is_repeatable(spark):
    df = spark.range(0, 10_000, 1, 4)
    one, two = (rows.sample_rows(df, 0.4, 1).collect() for _ in range(2))
    assert one == two and 3_700 < len(one) < 4_300 and len(set(one)) == len(one)


def test_reuse_of_an_input(spark):
    df = spark.range(10).persist()
    assert df.count() == 10 and df.storageLevel.useMemory
    assert not df.unpersist().storageLevel.useMemory


def test_observed_sum(spark):
    df, seen = aggregates.observed_sum(spark.createDataFrame([(1,), (2,), (3,), (4,)], "v int"), F.col("v"))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"total": 10}


def test_sql_functions(spark):
    tabular.register(spark)
    df = spark.createDataFrame([("a", 3), ("a", 4), ("b", None)], "k string, v int")
    df.createOrReplaceTempView("small")
    got = {r.k: r.m for r in spark.sql("SELECT k, integer_mean(v) AS m FROM small GROUP BY k").collect()}
    assert got == {"a": 3, "b": None}
    words = spark.sql("SELECT word, len FROM VALUES ('ab c') AS t(s), LATERAL split_words(s, ' ')").collect()
    assert [tuple(w) for w in words] == [("ab", 2), ("c", 1)]


def test_series_json(spark, tmp_path):
    df = spark.createDataFrame([(70, 5), (10, 3)], "at long, n long").withColumn("at", F.timestamp_seconds("at"))
    files.write_series_json(df, "at", "n", str(tmp_path / "s"))
    assert spark.read.text(str(tmp_path / "s")).first()[0] == '[{"xtime":"00:10","yval":"3"},{"xtime":"01:10","yval":"5"}]'


def test_scratch_is_under_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two
    if root:
        assert one.startswith(root)
