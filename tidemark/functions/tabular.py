"""Table functions and user-defined functions registered under a SQL name."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# types as objects: a type given as text can only be parsed inside a session
WORD = T.StructType([T.StructField("word", T.StringType()), T.StructField("len", T.IntegerType())])


def split_words(df: DataFrame, col: str, sep: str) -> DataFrame:
    """Lateral (word, len) rows per row of ``df``; ``sep`` is a regular expression."""
    return (
        df.withColumn("word", F.explode(F.split(col, sep)))
        .where(F.col("word") != "")
        .withColumn("len", F.length("word").cast("long"))
    )


@F.udtf(returnType=WORD)
class SplitWords:
    def eval(self, text: str, sep: str):
        if text is not None:
            for word in text.split(sep):
                if word:
                    yield word, len(word)


@F.pandas_udf(T.StringType())
def prefix_name_udf(name: pd.Series) -> pd.Series:
    return "Name: " + name


@F.pandas_udf(T.LongType())
def integer_mean_udaf(value: pd.Series) -> int:
    """Grouped aggregate without a partial step: prefer scalar.integer_mean."""
    kept = value.dropna()
    return int(kept.sum()) // len(kept) if len(kept) else None


def register(spark: SparkSession) -> None:
    """Make the functions callable from SQL text."""
    spark.udtf.register("split_words", SplitWords)
    spark.udf.register("prefix_name", prefix_name_udf)
    spark.udf.register("integer_mean", integer_mean_udaf)
