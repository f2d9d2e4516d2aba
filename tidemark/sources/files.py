"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).withColumn("path", F.input_file_name())


def csv(spark: SparkSession, path: str, ddl: str, **options) -> DataFrame:
    return spark.read.schema(ddl).options(**options).csv(path)


def json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def line_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)


def csv_stream(spark: SparkSession, path: str, ddl: str, **options) -> DataFrame:
    return spark.readStream.schema(ddl).options(**options).csv(path)


def file_per_batch_stream(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A queue of batches: each parquet file of the folder is one micro-batch, in
    order of modification time."""
    return spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(path)


def in_files(df: DataFrame, rows: int, files: int) -> DataFrame:
    """``df`` in parts of about ``rows``, of which there are at most ``files``; each is written as one file."""
    return df.repartition(max(1, min(files, -(-df.count() // rows))))


def write_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).csv(path)


def write_text(df: DataFrame, path: str, col: str = "value", mode: str = "errorifexists") -> None:
    """One text file per partition."""
    df.select(F.col(col).cast("string")).write.mode(mode).text(path)


def print_rows(df: DataFrame, n: int = 20) -> None:
    df.show(n, truncate=False)


def print_stream(stream: DataFrame, checkpoint: str, mode: str = "append") -> DataStreamWriter:
    """A console sink, for looking at a stream."""
    return stream.writeStream.format("console").outputMode(mode).option("checkpointLocation", checkpoint)


def tables(spark: SparkSession) -> DataFrame:
    """Tables and views of the session's catalog."""
    return spark.sql("SHOW TABLES")


def series_json(df: DataFrame, at: str, count: str) -> DataFrame:
    """One row: ``[{"xtime":"mm:ss","yval":"n"},...]`` in time order.

    For a series already reduced to the points of one chart.
    """
    point = F.struct(
        F.date_format(at, "mm:ss").alias("xtime"), F.col(count).cast("string").alias("yval")
    )
    points = F.array_sort(F.collect_list(F.struct(F.col(at).alias("at"), point.alias("p"))))
    return df.agg(F.to_json(F.transform(points, lambda x: x["p"])).alias("series"))


def write_series_json(df: DataFrame, at: str, count: str, path: str) -> None:
    series_json(df, at, count).write.mode("overwrite").text(path)
