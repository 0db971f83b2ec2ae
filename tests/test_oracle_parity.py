"""Every registered query with oracle SQL must equal DuckDB at sf0.01 (the driver's check)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from caseload.sources.tables import TABLES
from tools.oracle_check import canon, digest

SF = "/root/testdata/sf0.01"
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    s_cols, s_rows = canon(E.queries()[name](spark, SF).toPandas())
    o_cols, o_rows = canon(con.execute(SQL[name]).df())
    assert s_cols == o_cols
    assert len(s_rows) == len(o_rows)
    assert digest(s_rows) == digest(o_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert {"episode_id", "customer_public_id", "first_month", "last_month"} <= set(df.columns)
    rows = df.collect()
    assert rows and len({r.episode_id for r in rows}) == len(rows) and all(r.first_month <= r.last_month for r in rows)
