import pytest
from oracle import connect, same

from quillspark import queries


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, sf, con, name):
    same(queries.QUERIES[name](spark, sf), con, queries.SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_query_without_sql_runs(spark, sf, name):
    assert queries.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["path", "canonical", "records", "contents", "line"] and df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
