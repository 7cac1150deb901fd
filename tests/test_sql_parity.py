import pytest

from lawmill.plans import queries as core
from tests.parity import connect, rows


@pytest.fixture(scope="module")
def duck(data_dir):
    return connect(data_dir)


@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_query_equals_sql(spark, data_dir, duck, name):
    got = core.queries()[name](spark, data_dir).toPandas()
    want = duck.sql(core.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
    assert len(want) > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
