"""Every registered query with an oracle agrees with DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from quarry.sources.tables import TABLES
from tests.conftest import SF_SMALL
from tools.oracle_check import rows_of

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows_of(sdf.columns, srows) == rows_of(dcols, drows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "label" in df.columns
