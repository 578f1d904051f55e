"""Every registered query against its SQL, on the smallest tables."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry_points

QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.columns == ["query_id", "rank", "id", "distance"]
    assert frame.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    result = QUERIES[name](spark, sf_dir).toPandas()
    assert len(result)
    if name in SQL:
        assert difference(result, connect(sf_dir).execute(SQL[name]).df()) is None
