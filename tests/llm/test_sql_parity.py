import pytest

from lawmill.llm import queries as llm
from tests.parity import connect, rows


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_equals_sql(spark, data_dir, name):
    got = llm.queries()[name](spark, data_dir).toPandas()
    assert rows(got) == rows(connect(data_dir).sql(llm.oracle_sql()[name]).df())


@pytest.mark.parametrize("name", sorted(llm.queries()))
def test_query_runs(spark, data_dir, name):
    assert llm.queries()[name](spark, data_dir).count() >= 0
