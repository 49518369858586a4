"""Every registered query against its DuckDB oracle on the smallest test tables (the driver's gate at sf0.001)."""

import duckdb
import pytest

import oracle_queries
from oracle_check import TABLES, rows_of
from peerscore.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_queries.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert rows_of(df.columns, srows) == rows_of(ocols, orows)
