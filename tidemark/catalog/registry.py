"""Named queries over the given tables, each with the SQL it must agree with."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, same_as: str | None = None):
    """Register a (spark, sf_dir) -> DataFrame function under ``name``, with its SQL
    or with the SQL of the query that must give the same rows."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if same_as is not None:
            SQL[name] = SQL[same_as]
        elif sql is not None:
            SQL[name] = with_views(sql)
        return fn

    return add


def us(col: str, name: str | None = None) -> Column:
    """A timestamp as epoch microseconds, so that both engines print one thing."""
    return F.unix_micros(col).alias(name or col)


_K = "CAST(regexp_extract(props, '[0-9]+') AS BIGINT)"

# SQL twins of tidemark.sources.tables; `us` is the event time in microseconds
_VIEWS = {
    "ev": f"SELECT *, epoch_us(ts) AS us, {_K} AS k FROM events",
    "behaviour": "SELECT event_id, user_id, k AS item_id, k % 10 AS category_id, "
    "CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END AS behaviour, us FROM ev",
    "login": "SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END "
    "AS event_type, us FROM ev",
    "ad_click": "SELECT event_id, user_id, k % 6 AS ad_id, 'NATION_' || CAST(user_id % 25 AS VARCHAR) "
    "AS province, user_id % 5 AS city, us FROM ev WHERE event_type = 'click'",
    "order_event": "SELECT event_id, user_id AS order_id, CASE WHEN event_type = 'signup' THEN 'create' "
    "ELSE 'pay' END AS event_type, CASE WHEN event_type = 'purchase' THEN event_id END AS tx_id, us "
    "FROM ev WHERE event_type IN ('signup', 'purchase')",
    "receipt": "SELECT event_id AS tx_id, CASE WHEN event_id % 2 = 0 THEN 'wechat' ELSE 'alipay' END "
    "AS channel, us + (event_id % 11 - 4) * 1000000 AS us FROM ev "
    "WHERE event_type = 'purchase' AND event_id % 3 <> 0",
    "sensor": "SELECT event_id, 'ws_' || CAST(user_id % 20 AS VARCHAR) AS id, value AS temperature, us "
    "FROM ev",
    "visit": "SELECT event_id, user_id, CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y-%m-%d') AS session_id, "
    "k % 8 AS page_id, "
    "CASE WHEN event_type IN ('click', 'view', 'error') THEN CAST(k % 12 AS VARCHAR) END AS click_category_id, "
    "CASE WHEN event_type IN ('signup', 'error') THEN CAST(k % 12 AS VARCHAR) || ',' || "
    "CAST(event_id % 12 AS VARCHAR) END AS order_category_ids, "
    "CASE WHEN event_type IN ('purchase', 'error') THEN CAST(k % 12 AS VARCHAR) || ',' || "
    "CAST(event_id % 12 AS VARCHAR) END AS pay_category_ids, us FROM ev",
    "web_log": "SELECT event_id, '/page/' || CAST(k % 15 AS VARCHAR) AS url, "
    "CASE WHEN event_type IN ('view', 'click') THEN 'GET' ELSE 'POST' END AS method, us, "
    "us + (event_id % 7) * 600000000 AS arrival FROM ev",
}


def with_views(sql: str) -> str:
    """Put the record views that ``sql`` names in front of it."""
    body = sql.strip()
    used = {v for v in _VIEWS if re.search(rf"\b{v}\b", body)}
    if used:
        used.add("ev")
    ctes = ", ".join(f"{v} AS ({_VIEWS[v]})" for v in _VIEWS if v in used)
    if not ctes:
        return body
    if body[:5].upper() == "WITH ":
        recursive, rest = "", body[5:]
        if rest[:10].upper() == "RECURSIVE ":
            recursive, rest = "RECURSIVE ", rest[10:]
        return f"WITH {recursive}{ctes}, {rest}"
    return f"WITH {ctes} {body}"
