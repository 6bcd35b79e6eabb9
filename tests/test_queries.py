"""Driver contract: entry smoke check and every oracle query at sf0.001."""

import pytest

import __spark_entry__ as contract
from salesflow.oracle import ORACLE_SQL
from salesflow.queries import QUERIES
from tests.compare import compare, duck, python_nodes

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    df = contract.entry(spark)
    rows = df.collect()
    assert len(rows) == 6
    assert df.columns == ["category", "total_sales", "total_revenue", "avg_amount", "min_amount", "max_amount"]


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, SF, name, con)
    assert result["ok"], result
    assert result["python_nodes"] == [], result


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)


def test_reports_are_ordered(spark):
    """compare() ignores order, so the ordered reports are looked at here."""
    for name, keys in (("sales_by_category", ["category"]), ("sales_by_month", ["year", "month", "category"]),
                       ("sales_partition_revenue", ["year", "month", "category"])):
        got = [tuple(r) for r in QUERIES[name](spark, SF).select(*keys).collect()]
        assert got == sorted(got)
