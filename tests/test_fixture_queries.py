import duckdb
import fixture_queries
import pytest
from oracle import same


@pytest.mark.parametrize("name", sorted(fixture_queries.SQL))
def test_rows_worked_out_by_hand(spark, name):
    same(fixture_queries.QUERIES[name](spark, ""), duckdb.connect(), fixture_queries.SQL[name])
