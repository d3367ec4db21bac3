import pytest

from terraloom.plans import registry
from tests.sqlcheck import compare, views


@pytest.fixture(scope="module")
def db(sf):
    return views(sf)


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n in registry.SQL])
def test_same_rows_as_sql(spark, sf, db, name):
    compare(spark, db, sf, registry.QUERIES[name], registry.SQL[name])


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n not in registry.SQL])
def test_runs(spark, sf, name):
    assert registry.QUERIES[name](spark, sf.replace("0.001", "0.01")).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
