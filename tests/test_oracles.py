"""Every core query with SQL equals it on the smallest tables; the others run."""

import pytest
from compare import connect, rows_of

from sampleloom.plans.registry import all_oracles, all_queries

FOLDER = "/root/testdata/sf0.001"
SQL = all_oracles()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, con, name):
    df = all_queries()[name](spark, FOLDER)
    got = df.collect()
    if name in SQL:
        r = con.sql(SQL[name])
        assert sorted(df.columns) == sorted(r.columns)
        assert rows_of(df.columns, got) == rows_of(r.columns, r.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert set(SQL) <= set(e.queries())
