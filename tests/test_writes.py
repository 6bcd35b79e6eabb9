"""Write round trips: append, full overwrite, dynamic overwrite, NULL partitions, path reads."""

import threading
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from salesflow.operators import (
    insert_into,
    overwrite_partitions,
    overwrite_path_partitions,
    partition_files,
    save_table,
    table_location,
    with_partition_values,
)
from salesflow.plans import append_staging, load_partitioned, run_etl, stage_sales
from salesflow.queries import sales
from salesflow.session import scratch_database, scratch_location
from salesflow.sources import PARTITION_PATTERN, read_partitioned, sales_from_rows


def test_append_twice_keeps_duplicates(spark, fixture_a):
    location = stage_sales(fixture_a, scratch_location(spark, "staging"))
    tables = load_partitioned(spark, scratch_database(spark), location)
    append_staging(spark, tables)
    assert spark.table(tables.partitioned_table).count() == 12


def _two_batches(spark):
    first = sales_from_rows(spark, [(1, "2024-01-15", "a", 1.0, "A"), (2, "2024-01-15", "b", 2.0, "B")])
    second = sales_from_rows(spark, [(3, "2024-01-15", "c", 3.0, "B")])
    return with_partition_values(first), with_partition_values(second)


def test_full_overwrite_drops_other_partitions(spark):
    first, second = _two_batches(spark)
    table = f"{scratch_database(spark)}.t"
    save_table(first, table, partition_by=("category",))
    save_table(second, table, partition_by=("category",))
    assert sorted(r.id for r in spark.table(table).collect()) == [3]


def test_dynamic_overwrite_keeps_other_partitions(spark):
    first, second = _two_batches(spark)
    table = f"{scratch_database(spark)}.t"
    save_table(first, table, partition_by=("category",))
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    overwrite_partitions(second, table)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    assert sorted((r.category, r.id) for r in spark.table(table).collect()) == [("A", 1), ("B", 3)]


def test_path_dynamic_overwrite(spark):
    first, second = _two_batches(spark)
    path = scratch_location(spark, "bycat")
    overwrite_path_partitions(first, path, ("category",))
    overwrite_path_partitions(second, path, ("category",))
    assert sorted((r.category, r.id) for r in spark.read.parquet(path).collect()) == [("A", 1), ("B", 3)]


def test_insert_by_name_not_position(spark):
    first, _ = _two_batches(spark)
    table = f"{scratch_database(spark)}.t"
    save_table(first.limit(0), table, partition_by=("category", "year", "month"))
    insert_into(first.select("month", "year", "category", "amount", "product", "sale_date", "id"), table)
    assert sorted((r.id, r.category, r.month) for r in spark.table(table).collect()) == [(1, "A", "01"), (2, "B", "01")]


def test_null_partition_value_round_trip(spark):
    df = with_partition_values(sales_from_rows(spark, [(1, None, "x", 1.0, None)]))
    path = scratch_location(spark, "nulls")
    df.write.partitionBy("category", "year", "month").parquet(path)
    import os

    local = path.removeprefix("file:")
    assert os.path.isdir(os.path.join(local, "category=__HIVE_DEFAULT_PARTITION__"))
    back = read_partitioned(spark, path, integer_dates=False).collect()
    assert (back[0].category, back[0].year, back[0].month) == (None, None, None)


def test_partitioned_read_types(spark, fixture_a):
    location = stage_sales(fixture_a, scratch_location(spark, "staging"))
    tables = load_partitioned(spark, scratch_database(spark), location)
    root = table_location(spark, tables.partitioned_table)
    inferred = read_partitioned(spark, root)
    text = read_partitioned(spark, root, integer_dates=False)
    assert dict(inferred.dtypes)["month"] == "int" and {r.month for r in inferred.collect()} == {1, 10}
    assert dict(text.dtypes)["month"] == "string" and {r.month for r in text.collect()} == {"01", "10"}
    wildcard = read_partitioned(spark, root, pattern=PARTITION_PATTERN)
    assert sorted(map(tuple, wildcard.collect())) == sorted(map(tuple, inferred.collect()))
    assert "1 paths" in inferred._jdf.queryExecution().executedPlan().toString()
    # Without basePath the partition columns are not added.
    assert spark.read.parquet(f"{root}/category=*/year=*/month=*/").columns == ["id", "sale_date", "product", "amount"]


def test_wildcard_without_match_fails(spark):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_partitioned(spark, scratch_location(spark, "empty"), pattern=PARTITION_PATTERN).collect()


def test_partition_types_do_not_follow_the_values(spark):
    rows = with_partition_values(sales_from_rows(spark, [(1, "2021-10-31", "x", 1.0, "007"), (2, "2021-10-31", "y", 2.0, "010")]))
    path = scratch_location(spark, "digits")
    rows.write.partitionBy("category", "year", "month").parquet(path)
    for pattern in (None, PARTITION_PATTERN):
        back = read_partitioned(spark, path, pattern=pattern)
        assert dict(back.dtypes)["category"] == "string"
        assert sorted((r.category, r.year, r.month) for r in back.collect()) == [("007", 2021, 10), ("010", 2021, 10)]


def test_load_follows_its_folder(spark):
    """Another folder, files added to it, files replaced in it: each load takes what is there."""
    one = lambda i: sales_from_rows(spark, [(i, "2021-10-31", "x", 1.0, "A")])
    database = scratch_database(spark)
    day1, day2 = (scratch_location(spark, "day") for _ in range(2))
    stage_sales(one(1), day1)
    stage_sales(one(2).union(one(3)), day2)
    load_partitioned(spark, database, day1)
    tables = load_partitioned(spark, database, day2)
    ids = lambda: sorted(r.id for r in spark.table(tables.partitioned_table).collect())
    assert ids() == [1, 2, 3]
    one(4).write.mode("append").parquet(day2)
    load_partitioned(spark, database, day2, replace_partitions=True)
    assert ids() == [2, 3, 4]
    stage_sales(one(5), day2)
    load_partitioned(spark, database, day2, replace_partitions=True)
    assert ids() == [5]
    one(6).write.mode("append").parquet(day2)
    append_staging(spark, tables)
    assert ids() == [5, 5, 6]
    with pytest.raises(ValueError, match="exists with columns"):
        load_partitioned(spark, database, day2, id_type="bigint")


def test_partition_overwrite_leaves_other_writers_alone(spark):
    """While one thread replaces partitions, another one's whole-table insert stays whole."""
    first, second = _two_batches(spark)
    tables = [f"{scratch_database(spark)}.t" for _ in range(2)]
    for table in tables:
        save_table(first, table, partition_by=("category", "year", "month"))
    slow = second.withColumn("amount", F.udf(lambda x: (time.sleep(3), x)[1], "double")("amount"))
    thread = threading.Thread(target=overwrite_partitions, args=(slow, tables[0]))
    thread.start()
    time.sleep(1)
    second.select(*spark.table(tables[1]).columns).write.insertInto(tables[1], overwrite=True)
    thread.join()
    assert sorted(r.id for r in spark.table(tables[0]).collect()) == [1, 3]
    assert sorted(r.id for r in spark.table(tables[1]).collect()) == [3]


def test_etl_files_are_bounded_by_folders(spark):
    """A source of many small files: rebalanced, a folder gets few files."""
    rows = [(i, f"20{10 + i % 12}-0{1 + i % 9}-05", "x", 400.0 * (i % 4), f"c{i % 5}") for i in range(400)]
    loaded = load_partitioned(spark, scratch_database(spark), stage_sales(sales_from_rows(spark, rows), scratch_location(spark, "s")))
    tables = run_etl(spark, table_location(spark, loaded.partitioned_table), loaded.database)
    listing = partition_files(spark.table(tables.transformed), ("category", "price_category")).collect()
    assert len(listing) == 15 and max(r.files for r in listing) <= 2 and sum(r.rows for r in listing) == 400


def test_rewritten_days_reach_the_scan(spark):
    plan = sales(spark, "/root/testdata/sf0.001", "1999-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan


def test_write_option_is_ignored_by_insert_into(spark):
    """Why overwrite_partitions needs a session setting: the per-write option does not
    reach insertInto, so the other partition is lost."""
    first, second = _two_batches(spark)
    table = f"{scratch_database(spark)}.t"
    save_table(first, table, partition_by=("category", "year", "month"))
    second.select(*spark.table(table).columns).write.option("partitionOverwriteMode", "dynamic").insertInto(
        table, overwrite=True
    )
    assert sorted((r.category, r.id) for r in spark.table(table).collect()) == [("B", 3)]


def test_full_overwrite_under_session_dynamic_mode(spark):
    """The reference sets partitionOverwriteMode=dynamic for its whole session; saveAsTable
    still replaces the whole table (the setting only reaches insertInto and path writes)."""
    first, second = _two_batches(spark)
    table = f"{scratch_database(spark)}.t"
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        save_table(first, table, partition_by=("category",))
        save_table(second, table, partition_by=("category",))
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert sorted(r.id for r in spark.table(table).collect()) == [3]


def test_dropping_external_staging_table_keeps_files(spark, fixture_a):
    from salesflow.sources import create_external_table

    location = stage_sales(fixture_a, scratch_location(spark, "staging"))
    table = f"{scratch_database(spark)}.sales_staging"
    assert create_external_table(spark, table, location).count() == 6
    spark.sql(f"DROP TABLE {table}")
    assert spark.read.parquet(location).count() == 6


def test_load_with_partition_replace_is_rerunnable(spark, fixture_a):
    location = stage_sales(fixture_a, scratch_location(spark, "staging"))
    db = scratch_database(spark)
    for _ in range(2):
        tables = load_partitioned(spark, db, location, replace_partitions=True)
    assert spark.table(tables.partitioned_table).count() == 6
    load_partitioned(spark, db, location)
    assert spark.table(tables.partitioned_table).count() == 12
