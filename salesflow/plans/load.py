"""L1: staging Parquet -> partitioned table -> verification."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from salesflow.operators import (
    create_database,
    create_partitioned_sales_table,
    insert_into,
    list_partitions,
    overwrite_partitions,
    partition_revenue,
    sort_rows,
    using_database,
    with_partition_values,
)
from salesflow.schema import REVENUE_COLUMNS, partitioned_sales_schema
from salesflow.sources import check_columns, create_external_table, write_staging_file


@dataclass(frozen=True)
class LoadedTables:
    database: str
    staging_table: str
    partitioned_table: str
    staging_location: str


def stage_sales(raw: DataFrame, location: str, id_type: str = "int") -> str:
    """Write raw sales rows as the staging Parquet dataset."""
    return write_staging_file(raw, location, id_type)


def load_partitioned(
    spark: SparkSession,
    database: str,
    staging_location: str,
    id_type: str = "int",
    staging_name: str = "sales_staging",
    table_name: str = "sales_partitioned",
    replace_partitions: bool = False,
) -> LoadedTables:
    """Create the database and, inside it (unqualified names, as with
    ``USE``), an external staging table over the files and the partitioned table; then
    append every staging row into its (category, year, month) partition. Running it
    twice appends the rows twice, as the reference does. A staging table that exists is
    pointed at the given folder and its listing refreshed, so the rows loaded are those of
    the folder as it is now.

    ``replace_partitions`` replaces the partitions the staging rows fall into instead
    (K5), so re-running the same load, e.g. after a failed job, leaves one copy."""
    create_database(spark, database)
    with using_database(spark, database):
        staging = create_external_table(spark, staging_name, staging_location, id_type)
        create_partitioned_sales_table(spark, table_name, id_type)
        check_columns(spark, table_name, partitioned_sales_schema(id_type))
        if replace_partitions:
            overwrite_partitions(with_partition_values(staging), table_name)
        else:
            insert_into(with_partition_values(staging), table_name)
    return LoadedTables(database, f"{database}.{staging_name}", f"{database}.{table_name}", staging_location)


def append_staging(spark: SparkSession, tables: LoadedTables) -> None:
    """K1 again: append the staging rows once more (no de-duplication), with the files that are there now."""
    spark.sql(f"REFRESH TABLE {tables.staging_table}")
    insert_into(with_partition_values(spark.table(tables.staging_table)), tables.partitioned_table)


def verify_load(spark: SparkSession, table: str) -> DataFrame:
    """G1 + O2: ``category, year, month, cnt, revenue`` ordered by year, month, category."""
    agg = partition_revenue(spark.table(table))
    return sort_rows(agg, "year", "month", "category").select(*REVENUE_COLUMNS)


def loaded_partitions(spark: SparkSession, table: str) -> DataFrame:
    """C4 after the load."""
    return list_partitions(spark, table)
