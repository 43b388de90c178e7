"""Every registered query equals its DuckDB oracle on the smallest test data."""

import pytest

import __spark_entry__ as E
from martlake import catalog
from tests.helpers import canon, duck

QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(small_dir):
    return duck(small_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_parity(spark, small_dir, con, name):
    df = QUERIES[name](spark, small_dir)
    scols = df.columns
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert sorted(scols) == sorted(ocols)
    assert canon(scols, srows) == canon(ocols, res.fetchall())


def test_every_query_has_oracle_or_is_listed():
    no_oracle = set(QUERIES) - set(ORACLE)
    assert no_oracle <= set(E.NON_SQL_QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "procurement_rank" in df.columns
