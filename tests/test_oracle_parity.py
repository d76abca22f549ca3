"""Every registered query with an oracle equals DuckDB on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from crashlens.sources.tables import TABLES
from conftest import SF_SMALL
from tools.oracle_check import _rows

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    got = queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(ORACLES[name]).df()
    c1, r1 = _rows(got)
    c2, r2 = _rows(want)
    assert c1 == c2
    assert r1 == r2, (list((r1 - r2).elements())[:3], list((r2 - r1).elements())[:3])


def test_every_query_has_entry_contract(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() >= 0
    assert set(ORACLES) <= set(queries())
