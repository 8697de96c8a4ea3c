import pytest

import __spark_entry__ as contract
from sectorlens import registry
from tests.helpers import TINY
from tests.oracle import compare

QUERIES, SQL = registry.QUERIES, registry.SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, name, QUERIES[name], SQL[name], TINY) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_contract_has_them_all():
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["sector", "industry_key", "industry_name", "market_weight"]
    assert df.count() == 5


def test_no_query_has_a_scalar_python_function(spark):
    for name in ("top_sector", "top_sector_company_news", "news_flatten", "dq_tick_interval"):
        plan = QUERIES[name](spark, TINY)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan
