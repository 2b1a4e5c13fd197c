"""Every registered query against its DuckDB oracle on the smallest test tables.

Row count, column names and the multiset of values must be equal (floats compared
by their exact text).  The driver repeats this at sf0.01 (tools/check_oracle.py
runs the same comparison locally at any scale)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from cinelake.plans.registry import QUERIES  # noqa: E402
from cinelake.plans.registry_sql import ORACLE_SQL  # noqa: E402
from check_oracle import TABLES, rows_of_duck, rows_of_spark  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


#: The library's own queries; the training-data operators have tests of their own.
OWN = sorted(set(QUERIES) & set(entry.queries()))


def test_every_query_has_an_oracle():
    assert set(OWN) == set(QUERIES) == set(ORACLE_SQL)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert set(df.columns) == {"genre", "quarter", "revenue", "films", "share_pct"}
    assert df.count() >= 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    s_cols, s_rows = rows_of_spark(df)
    d_cols, d_rows = rows_of_duck(duck.sql(entry.oracle_sql()[name]))
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows
