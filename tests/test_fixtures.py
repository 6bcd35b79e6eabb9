"""The three jobs on small rows, with results worked out by hand (FIXTURES.md)."""

import datetime as dt

from salesflow.operators import list_partitions, table_location
from salesflow.plans import (
    category_report,
    load_partitioned,
    monthly_report,
    run_aggregate_job,
    run_etl,
    stage_sales,
    verify_load,
)
from salesflow.session import scratch_database, scratch_location


def _load_a(spark, fixture_a):
    location = stage_sales(fixture_a, scratch_location(spark, "staging"))
    return load_partitioned(spark, scratch_database(spark), location)


def test_partitioned_load(spark, fixture_a):
    tables = _load_a(spark, fixture_a)
    parts = sorted(r[0] for r in list_partitions(spark, tables.partitioned_table).collect())
    assert parts == [
        "category=home goods/year=2021/month=10",
        "category=home goods/year=2022/month=01",
        "category=sport/year=2021/month=10",
        "category=sport/year=2022/month=01",
    ]
    got = [tuple(r) for r in verify_load(spark, tables.partitioned_table).collect()]
    assert got == [
        ("home goods", "2021", "10", 2, 1299.99),
        ("sport", "2021", "10", 1, 20.25),
        ("home goods", "2022", "01", 2, 600.0),
        ("sport", "2022", "01", 1, 2499.5),
    ]
    schema = spark.table(tables.partitioned_table).schema
    assert [(f.name, f.dataType.simpleString()) for f in schema.fields] == [
        ("id", "int"), ("sale_date", "string"), ("product", "string"), ("amount", "double"),
        ("category", "string"), ("year", "string"), ("month", "string"),
    ]


def test_aggregate_job(spark, fixture_b):
    table = run_aggregate_job(fixture_b, f"{scratch_database(spark)}.sales_aggregated")
    df = spark.table(table)
    assert df.columns == ["total_amount", "total_sales", "avg_amount", "category", "year", "month"]
    got = {(r.category, r.year, r.month, r.total_amount, r.total_sales, r.avg_amount) for r in df.collect()}
    assert got == {
        ("books", "2023", "02", 52.5, 2, 26.25),
        ("books", "2023", "12", 5.75, 1, 5.75),
        ("toys & games", "2023", "02", 60.0, 1, 60.0),
        ("toys & games", "2023", "12", 30.0, 2, 15.0),
    }


def test_etl(spark, fixture_a):
    loaded = _load_a(spark, fixture_a)
    tables = run_etl(spark, table_location(spark, loaded.partitioned_table), loaded.database)

    transformed = spark.table(tables.transformed)
    assert transformed.columns == [
        "id", "sale_date", "product", "amount", "year", "month", "category", "price_category"
    ]
    types = dict(transformed.dtypes)
    assert (types["sale_date"], types["year"], types["month"]) == ("date", "int", "int")
    rows = sorted((r.id, r.product, r.price_category) for r in transformed.collect())
    assert rows == [
        (1, "Wall Clock", "premium"), (2, "Oil Lamp", "budget"), (3, "Kettle", "mid"),
        (4, "Kettle", "mid"), (5, "Gravel Bike", "premium"), (6, "Yoga Mat", "budget"),
    ]
    assert {r.month for r in transformed.collect()} == {1, 10}
    assert transformed.where("id = 1").first().sale_date == dt.date(2021, 10, 31)
    parts = sorted(r[0] for r in list_partitions(spark, tables.transformed).collect())
    assert parts == [
        "category=home goods/price_category=budget",
        "category=home goods/price_category=mid",
        "category=home goods/price_category=premium",
        "category=sport/price_category=budget",
        "category=sport/price_category=premium",
    ]

    by_cat = [tuple(r) for r in category_report(spark, tables).collect()]
    assert by_cat == [
        ("home goods", 4, 1899.99, 475.0, 299.99, 1000.0),
        ("sport", 2, 2519.75, 1259.88, 20.25, 2499.5),
    ]

    by_month = monthly_report(spark, tables)
    assert by_month.columns == ["category", "total_sales", "total_revenue", "avg_amount", "year", "month"]
    got = [(r.year, r.month, r.category, r.total_sales, r.total_revenue, r.avg_amount) for r in by_month.collect()]
    assert got == [
        (2021, 10, "home goods", 2, 1299.99, 650.0),
        (2021, 10, "sport", 1, 20.25, 20.25),
        (2022, 1, "home goods", 2, 600.0, 300.0),
        (2022, 1, "sport", 1, 2499.5, 2499.5),
    ]
    month_parts = sorted(r[0] for r in list_partitions(spark, tables.by_month).collect())
    assert month_parts == ["year=2021/month=10", "year=2022/month=1"]


def test_aggregate_job_partition_overwrite(spark, fixture_b):
    from salesflow.sources import sales_from_rows

    table = f"{scratch_database(spark)}.sales_aggregated"
    run_aggregate_job(fixture_b, table, overwrite="partitions")
    rerun = sales_from_rows(spark, [(7, "2023-02-11", "diary", 10.0, "books")])
    run_aggregate_job(rerun, table, overwrite="partitions")
    got = {(r.category, r.month): (r.total_amount, r.total_sales) for r in spark.table(table).collect()}
    assert got == {
        ("books", "02"): (10.0, 1),
        ("books", "12"): (5.75, 1),
        ("toys & games", "02"): (60.0, 1),
        ("toys & games", "12"): (30.0, 2),
    }
    run_aggregate_job(rerun, table)
    assert spark.table(table).count() == 1
