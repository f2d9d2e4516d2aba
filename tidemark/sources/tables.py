"""The given tables, and the behaviour, login, order and sensor views derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def with_instant(events: DataFrame) -> DataFrame:
    """``ts`` is stored without a zone; it is read as UTC."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_instant(table(spark, sf_dir, "events"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream.

    A file stream takes folders or glob patterns; this pattern matches the table
    whether it is one file or a folder of files.
    """
    schema = table(spark, sf_dir, "events").schema
    return with_instant(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]"))


def _k():
    return F.regexp_extract("props", "[0-9]+", 0).cast("long")


def behaviour(ev: DataFrame) -> DataFrame:
    k = _k()
    return ev.select(
        "event_id", "user_id", k.alias("item_id"), (k % 10).alias("category_id"),
        F.when(F.col("event_type") == "view", "pv").otherwise(F.col("event_type")).alias("behaviour"),
        "ts",
    )


def logins(ev: DataFrame) -> DataFrame:
    return ev.select(
        "event_id", "user_id",
        F.when(F.col("event_type") == "error", "fail").otherwise("success").alias("event_type"), "ts",
    )


def ad_clicks(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == "click").select(
        "event_id", "user_id", (_k() % 6).alias("ad_id"),
        F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("province"),
        (F.col("user_id") % 5).alias("city"), "ts",
    )


def order_events(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type").isin("signup", "purchase")).select(
        "event_id", F.col("user_id").alias("order_id"),
        F.when(F.col("event_type") == "signup", "create").otherwise("pay").alias("event_type"),
        F.when(F.col("event_type") == "purchase", F.col("event_id")).alias("tx_id"), "ts",
    )


def receipts(ev: DataFrame) -> DataFrame:
    shift = F.make_dt_interval(secs=(F.col("event_id") % 11 - 4).cast("decimal(18,6)"))
    paid = (F.col("event_type") == "purchase") & (F.col("event_id") % 3 != 0)
    return ev.where(paid).select(
        F.col("event_id").alias("tx_id"),
        F.when(F.col("event_id") % 2 == 0, "wechat").otherwise("alipay").alias("channel"),
        (F.col("ts") + shift).alias("ts"),
    )


def sensor(ev: DataFrame) -> DataFrame:
    return ev.select(
        "event_id", F.concat(F.lit("ws_"), (F.col("user_id") % 20).cast("string")).alias("id"),
        F.col("value").alias("temperature"), "ts",
    )


def visits(ev: DataFrame) -> DataFrame:
    """Page visits; the id lists hold two categories, or are null like missing ones."""
    k = _k()
    pair = F.concat_ws(",", (k % 12).cast("string"), (F.col("event_id") % 12).cast("string"))
    kind = F.col("event_type")
    return ev.select(
        "event_id", "user_id",
        F.concat_ws("_", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("session_id"),
        (k % 8).alias("page_id"),
        F.when(kind.isin("click", "view", "error"), (k % 12).cast("string")).alias("click_category_id"),
        F.when(kind.isin("signup", "error"), pair).alias("order_category_ids"),
        F.when(kind.isin("purchase", "error"), pair).alias("pay_category_ids"),
        "ts",
    )


def web_log(ev: DataFrame) -> DataFrame:
    """Requests with the time they arrive, up to an hour after the event."""
    k = _k()
    late = F.make_dt_interval(mins=((F.col("event_id") % 7) * 10).cast("int"))
    return ev.select(
        "event_id", F.concat(F.lit("/page/"), (k % 15).cast("string")).alias("url"),
        F.when(F.col("event_type").isin("view", "click"), "GET").otherwise("POST").alias("method"),
        "ts", (F.col("ts") + late).alias("arrival"),
    )
