"""Every registered query with an oracle matches DuckDB on the smallest tables."""

import pytest

from tools.compare import compare, duck

from .conftest import SF_SMALL


def _names():
    from __spark_entry__ import oracle_sql
    return sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries
    sp = queries()[name](spark, SF_SMALL).toPandas()
    dd = con.execute(oracle_sql()[name]).df()
    ok, msg = compare(sp, dd)
    assert ok, msg


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert len(df.columns) == 409
    assert df.count() > 0


def test_every_oracle_has_a_query():
    from __spark_entry__ import oracle_sql, queries
    assert set(oracle_sql()) <= set(queries())
