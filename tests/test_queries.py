"""Every query of the catalogue agrees with its SQL twin on the smallest data set."""

import pytest

from __spark_entry__ import entry
from oracle import compare, connect
from tidemark.catalog import all_queries, all_sql

SF = "/root/testdata/sf0.001"
SQLS = all_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, con, name):
    verdict = compare(spark, SF, all_queries()[name], SQLS.get(name), con)
    assert verdict in ("", "empty")


def test_every_query_has_sql():
    assert set(SQLS) == set(all_queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["item_id", "window_end", "cnt", "rank"] and df.count() > 0
