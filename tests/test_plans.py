"""Physical plan properties: pruning, pushdown, partial aggregation, no Python, no forced broadcast."""

import contextlib
import io

import pytest

import __spark_entry__ as contract
from salesflow.operators import clean_sales, monthly_totals, table_location
from salesflow.plans import load_partitioned, stage_sales
from salesflow.queries import sales as adapter
from salesflow.session import scratch_database, scratch_location
from salesflow.sources import ADAPTER_ID_TYPE, read_partitioned

SF = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_flagship_reads_only_needed_columns(spark):
    plan = plan_text(contract.entry(spark))
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double>" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string>" in plan
    assert "partial_sum" in plan and "partial_count" in plan


@pytest.fixture(scope="module")
def loaded(spark):
    return load_partitioned(
        spark, scratch_database(spark), stage_sales(adapter(spark, SF), scratch_location(spark, "st"), ADAPTER_ID_TYPE),
        id_type=ADAPTER_ID_TYPE,
    )


def test_etl_totals_read_amount_only(spark, loaded):
    root = table_location(spark, loaded.partitioned_table)
    plan = plan_text(monthly_totals(clean_sales(read_partitioned(spark, root, id_type=ADAPTER_ID_TYPE))))
    assert "ReadSchema: struct<amount:double>" in plan


def test_partition_filter_prunes_folders(spark, loaded):
    df = spark.table(loaded.partitioned_table).where("category = 'PROMO' AND year = '1997'")
    plan = plan_text(df.groupBy().sum("amount"))
    assert "PartitionFilters: [" in plan and "(category#" in plan and "= PROMO)" in plan
    kept = {(r.category, r.year) for r in df.select("category", "year").distinct().collect()}
    assert kept <= {("PROMO", "1997")}


@pytest.mark.parametrize("name", ["sales_scan", "sales_date_parts", "sales_clean", "sales_count", "sales_sample"])
def test_no_python_in_plans(spark, name):
    plan = plan_text(contract.queries()[name](spark, SF))
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert python_node not in plan


def test_join_broadcasts_only_under_the_size_check(spark):
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = plan_text(adapter(spark, SF))
        assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
    assert "BroadcastHashJoin" in plan_text(adapter(spark, SF))
