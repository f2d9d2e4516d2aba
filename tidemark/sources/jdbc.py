"""Tables of a database over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_options(
    url: str, table: str, partition_column: str | None = None,
    lower: int | None = None, upper: int | None = None, partitions: int = 1, **props: str,
) -> dict[str, str]:
    """Options of a parallel read: each partition asks for one range of the column."""
    options = {"url": url, "dbtable": table, **props}
    if partition_column is not None:
        if lower is None or upper is None:
            raise ValueError("a partitioned read needs lower and upper bounds")
        options |= {
            "partitionColumn": partition_column, "lowerBound": str(lower),
            "upperBound": str(upper), "numPartitions": str(partitions),
        }
    return options


def read_table(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(url, table, **options)).load()


def append_table(df: DataFrame, url: str, table: str, **props: str) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, **props).mode("append").save()
