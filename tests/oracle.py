"""Compare a query with its SQL twin run by DuckDB on the same parquet files."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def compare(spark, sf_dir: str, fn, sql: str | None, con=None) -> str:
    """'' when both give the same columns and the same bag of rows."""
    df = fn(spark, sf_dir)
    cols = sorted(df.columns)
    mine = Counter(tuple(_plain(v) for v in r) for r in df.select(*cols).collect())
    if sql is None:
        return ""
    con = con or connect(sf_dir)
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    if sorted(names) != cols:
        return f"columns {cols} != {sorted(names)}"
    at = [names.index(c) for c in cols]
    theirs = Counter(tuple(_plain(r[i]) for i in at) for r in res.fetchall())
    if mine == theirs:
        return "" if mine else "empty"
    a, b = mine - theirs, theirs - mine
    return (
        f"rows {sum(mine.values())} vs {sum(theirs.values())}; "
        f"only spark {sum(a.values())} {list(a)[:2]}; only sql {sum(b.values())} {list(b)[:2]}"
    )


if __name__ == "__main__":  # python tests/oracle.py SF_DIR [name prefixes...]
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from conftest import session

    sf, prefixes = sys.argv[1], tuple(sys.argv[2:])
    spark, con, sqls = session(), connect(sf), oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        t = time.time()
        try:
            verdict = compare(spark, sf, fn, sqls.get(name), con)
        except Exception as e:  # report and go on to the next query
            verdict = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(verdict)
        print(f"{'ok ' if not verdict else 'BAD'} {name} {time.time() - t:.1f}s "
              f"{'' if name in sqls else '(no sql)'} {verdict}", flush=True)
    print("bad:", bad)
