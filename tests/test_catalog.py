"""Catalog helpers, declared schemas and casts."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from salesflow.functions import month_of, year_of
from salesflow.operators import create_database, partition_columns, use_database, using_database
from salesflow.schema import partitioned_sales_ddl, raw_sales_ddl, raw_sales_schema
from salesflow.session import scratch_database
from salesflow.sources import conform, table_path


def test_using_database_restores_the_previous_one(spark):
    db = scratch_database(spark)
    before = spark.catalog.currentDatabase()
    with pytest.raises(RuntimeError):
        with using_database(spark, db):
            assert spark.catalog.currentDatabase() == db
            raise RuntimeError("inside")
    assert spark.catalog.currentDatabase() == before
    use_database(spark, before)


def test_create_database_is_idempotent(spark):
    db = scratch_database(spark)
    assert create_database(spark, db) == db
    spark.sql(f"CREATE TABLE {db}.t (a INT, p STRING) USING PARQUET PARTITIONED BY (p)")
    assert partition_columns(spark, f"{db}.t") == ["p"]


def test_declared_ddl():
    assert raw_sales_ddl() == "id INT, sale_date STRING, product STRING, amount DOUBLE, category STRING"
    assert partitioned_sales_ddl("bigint") == (
        "id BIGINT, sale_date STRING, product STRING, amount DOUBLE, category STRING, year STRING, month STRING"
    )
    with pytest.raises(ValueError):
        raw_sales_schema("smallint")


def test_conform_fails_on_overflow_instead_of_null(spark):
    df = spark.range(1).select(F.lit(2**40).alias("id"), F.lit("2024-01-01").alias("sale_date"),
                               F.lit("x").alias("product"), F.lit(1).alias("amount"), F.lit("c").alias("category"))
    ok = conform(df, raw_sales_schema("bigint")).first()
    assert ok.id == 2**40 and ok.amount == 1.0
    before = spark.conf.get("spark.sql.ansi.enabled")
    for mode in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", mode)
        try:
            assert conform(df, raw_sales_schema("bigint")).first().id == 2**40
            for lost in (df, df.withColumn("id", F.lit(1.5)), df.withColumn("id", F.lit("one")), df.withColumn("id", F.lit(2**31))):
                with pytest.raises(PySparkException, match="id does not fit int"):
                    conform(lost, raw_sales_schema("int")).collect()
        finally:
            spark.conf.set("spark.sql.ansi.enabled", before)


def test_date_parts_are_int(spark):
    df = spark.range(1).select(F.to_date(F.lit("2024-03-09")).alias("d"))
    row = df.select(year_of("d").alias("y"), month_of("d").alias("m")).first()
    assert (row.y, row.m) == (2024, 3)
    assert dict(df.select(year_of("d").alias("y")).dtypes)["y"] == "int"


def test_table_path():
    assert table_path("/data/sf1/", "lineitem") == "/data/sf1/lineitem.parquet"
