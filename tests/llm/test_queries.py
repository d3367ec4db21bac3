import pytest

from terraloom.llm import queries as q
from tests.sqlcheck import compare, views


@pytest.fixture(scope="module")
def db(sf):
    return views(sf)


@pytest.mark.parametrize("name", list(q.SQL))
def test_same_rows_as_sql(spark, sf, db, name):
    compare(spark, db, sf, q.QUERIES[name], q.SQL[name])


@pytest.mark.parametrize("name", [n for n in q.QUERIES if n not in q.SQL])
def test_runs(spark, sf, name):
    assert q.QUERIES[name](spark, sf).count() > 0
