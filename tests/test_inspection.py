"""Table inspection (L4): count, columns, schema, partitions, balance, sample; file listing."""

from salesflow.operators import list_tables, partition_files
from salesflow.plans import inspect_table, load_partitioned, stage_sales
from salesflow.session import scratch_database, scratch_location


def _loaded(spark, fixture_a):
    return load_partitioned(spark, scratch_database(spark), stage_sales(fixture_a, scratch_location(spark, "staging")))


def test_inspect_partitioned_table(spark, fixture_a):
    tables = _loaded(spark, fixture_a)
    report = inspect_table(spark, tables.partitioned_table)
    assert report.row_count.first().row_count == 6
    assert report.columns == ["id", "sale_date", "product", "amount", "category", "year", "month"]
    assert " |-- id: integer (nullable = true)" in report.schema_tree
    described = [(r.col_name, r.data_type) for r in report.schema.collect()]
    assert ("id", "int") in described and ("month", "string") in described
    assert report.partitions.count() == 4
    assert sum(r.rows for r in report.balance.collect()) == 6
    sample = [r.id for r in report.sample.collect()]
    assert len(sample) == 3 and set(sample) <= {1, 2, 3, 4, 5, 6}
    ordered = inspect_table(spark, tables.partitioned_table, ordered_sample=True)
    assert [r.id for r in ordered.sample.collect()] == [1, 2, 3]


def test_inspect_unpartitioned_table(spark, fixture_a):
    tables = _loaded(spark, fixture_a)
    report = inspect_table(spark, tables.staging_table)
    assert report.partitions is None
    assert report.row_count.first().row_count == 6


def test_partition_files_and_tables(spark, fixture_a):
    tables = _loaded(spark, fixture_a)
    files = {(r.category, r.month): (r.files, r.rows) for r in partition_files(spark.table(tables.partitioned_table)).collect()}
    assert files == {
        ("home goods", "10"): (1, 2),
        ("home goods", "01"): (1, 2),
        ("sport", "10"): (1, 1),
        ("sport", "01"): (1, 1),
    }
    names = sorted(r.tableName for r in list_tables(spark, tables.database).collect())
    assert names == ["sales_partitioned", "sales_staging"]


def test_staging_listing_without_partitions(spark, fixture_a):
    tables = _loaded(spark, fixture_a)
    listing = partition_files(spark.table(tables.staging_table), ()).collect()
    assert len(listing) == 1 and listing[0].files >= 1 and listing[0].rows == 6 and listing[0].bytes > 0
