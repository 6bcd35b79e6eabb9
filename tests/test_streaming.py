"""Incremental partitioned load: each staging file is loaded once, across restarts."""

from salesflow.operators import partition_revenue
from salesflow.session import scratch_location
from salesflow.sources import sales_from_rows, write_staging_file
from salesflow.streaming import read_incremental_output, run_incremental_load
from tests.conftest import FIXTURE_A


def test_incremental_load_exactly_once(spark):
    staging = scratch_location(spark, "staging")
    out = scratch_location(spark, "stream-out")
    ckpt = scratch_location(spark, "stream-ckpt")

    first = sales_from_rows(spark, FIXTURE_A[:4]).coalesce(1)
    first.write.mode("append").parquet(staging)
    run_incremental_load(spark, staging, out, ckpt, files_per_batch=1)
    assert read_incremental_output(spark, out).count() == 4

    # A second run with nothing new changes nothing.
    run_incremental_load(spark, staging, out, ckpt)
    assert read_incremental_output(spark, out).count() == 4

    # New files are picked up; old ones are not loaded again.
    sales_from_rows(spark, FIXTURE_A[4:]).coalesce(1).write.mode("append").parquet(staging)
    run_incremental_load(spark, staging, out, ckpt)
    df = read_incremental_output(spark, out)
    got = [tuple(r) for r in partition_revenue(df).orderBy("year", "month", "category").collect()]
    assert got == [
        ("home goods", "2021", "10", 2, 1299.99),
        ("sport", "2021", "10", 1, 20.25),
        ("home goods", "2022", "01", 2, 600.0),
        ("sport", "2022", "01", 1, 2499.5),
    ]
    assert dict(df.dtypes)["month"] == "string"


def test_write_staging_file_types(spark):
    path = scratch_location(spark, "staging")
    write_staging_file(sales_from_rows(spark, FIXTURE_A), path)
    assert dict(spark.read.parquet(path).dtypes)["id"] == "int"


def test_a_hot_value_of_equal_rows_uses_many_writers(spark):
    staging, out = scratch_location(spark, "staging"), scratch_location(spark, "stream-out")
    sales_from_rows(spark, [(1, "2021-10-31", "kettle", 1.0, "hot")] * 2000).coalesce(1).write.parquet(staging)
    run_incremental_load(spark, staging, out, scratch_location(spark, "stream-ckpt"), writers_per_value=16)
    loaded = read_incremental_output(spark, out)
    assert loaded.count() == 2000
    assert loaded.select("_metadata.file_path").distinct().count() > 4
