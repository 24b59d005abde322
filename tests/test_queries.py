"""Every named query runs, and where it has SQL agrees with it."""

import pytest
from compare import compare, duck

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n != "pipeline" and not n.startswith("op")))
def test_query(spark, small, con, name):
    df = QUERIES[name](spark, small)
    if name in SQL:
        assert compare(df, con, SQL[name]) == []
    else:
        assert df.count() > 0


def test_only_random_starts_lack_sql():
    without = set(QUERIES) - set(SQL)
    without = {n for n in without if n != "pipeline" and not n.startswith("op")}  # tests/llm hold those
    assert without == {"choose_k", "kmeans_segments", "isolation_forest"}
    assert set(SQL) <= set(QUERIES)


def test_entry(spark, small):
    df = entry.entry(spark)
    assert df.columns[0] == "visit_id" and df.count() > 0
