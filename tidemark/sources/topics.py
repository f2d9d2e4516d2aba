"""Message topics (Kafka). The connector package must be on the class path to
start these; encoding and decoding of payloads is plain DataFrame work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.sources.lines import parse_delimited


def topic_stream(
    spark: SparkSession, servers: str, topic: str, offsets: str = "latest"
) -> DataFrame:
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", offsets)
        .load()
    )


def payload(messages: DataFrame) -> DataFrame:
    """The message body as text in ``value``."""
    return messages.select(F.col("value").cast("string").alias("value"))


def decode(messages: DataFrame, sep: str, schema: str) -> tuple[DataFrame, DataFrame]:
    return parse_delimited(payload(messages), sep, schema)


def encode(df: DataFrame) -> DataFrame:
    """Rows as comma-separated message bodies."""
    return df.select(F.to_csv(F.struct("*")).alias("value"))


def write_topic(df: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    return (
        encode(df).writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )


def load_file(spark: SparkSession, path: str, servers: str, topic: str) -> None:
    """Every line of a file as a message."""
    (
        spark.read.text(path).write.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    )
