"""Text lines to typed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalar import web_log_time


def parse_delimited(
    df: DataFrame, sep: str, schema: str | T.StructType, col: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """(records, bad lines). ``sep`` is a regular expression.

    A line is bad when it has the wrong number of fields or when a field that is
    not empty does not cast to its type. An empty text field stays empty.
    """
    fields = _fields(schema)
    # -1 keeps trailing empty fields, such as the missing id at the end of a line.
    # explode keeps the split in a step of its own: as a plain column it would be
    # copied into every field's cast and check and run once for each.
    pieces = F.split(_without_cr(F.col(col)), sep, -1)
    split = df.withColumn("_f", F.explode(F.array(pieces)))
    typed = [_typed(F.get("_f", F.lit(i)), f).alias(f.name) for i, f in enumerate(fields)]
    good = F.size("_f") == len(fields)
    for i, f in enumerate(fields):
        raw = F.get("_f", F.lit(i))
        good = good & ((F.trim(raw) == "") | _typed(raw, f).isNotNull())
    checked = split.withColumn("_good", F.coalesce(good, F.lit(False)))
    return (
        checked.where("_good").select(*typed),
        checked.where(~F.col("_good") & (F.trim(F.col(col)) != "")).select(col),
    )


def _without_cr(line: Column) -> Column:
    return F.rtrim(line, F.lit("\r"))


def _fields(schema: str | T.StructType) -> list[T.StructField]:
    return (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields


def _typed(raw: Column, field: T.StructField) -> Column:
    return raw if isinstance(field.dataType, T.StringType) else raw.try_cast(field.dataType)


def parse_web_log(df: DataFrame, col: str = "value") -> DataFrame:
    """ip, user_id, ts, method, url from blank-separated fields 0, 1, 3, 5 and 6.

    Blank lines and lines whose time does not parse give no record.
    """
    part = F.col("_f")
    return df.select(F.explode(F.array(F.split(_without_cr(F.col(col)), " "))).alias("_f")).select(
        F.get(part, F.lit(0)).alias("ip"), F.get(part, F.lit(1)).alias("user_id"),
        web_log_time(F.get(part, F.lit(3))).alias("ts"),
        F.get(part, F.lit(5)).alias("method"), F.get(part, F.lit(6)).alias("url"),
    ).where(F.col("ts").isNotNull() & F.col("url").isNotNull())


VISIT_SCHEMA = (
    "date string, user_id long, session_id string, page_id long, action_time string, "
    "search_keyword string, click_category_id long, click_product_id long, "
    "order_category_ids string, order_product_ids string, pay_category_ids string, "
    "pay_product_ids string, city_id long"
)


def missing_to_null(df: DataFrame) -> DataFrame:
    """``-1`` and ``null`` mean that a value is missing."""
    absent = [F.col(c).cast("string").isin("-1", "null") for c in df.columns]
    return df.select(*[F.when(~a, F.col(c)).alias(c) for c, a in zip(df.columns, absent)])
