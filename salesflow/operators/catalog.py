"""Catalog and table definition."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.functions.names import quoted_text
from salesflow.schema import SALES_PARTITION_COLUMNS, partitioned_sales_ddl
from salesflow.sources.listing import folder_value

#: Partitions that one statement drops.
DROP_BATCH = 200


def create_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    """Create the database unless it exists."""
    where = f" LOCATION {quoted_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")
    return name


def use_database(spark: SparkSession, name: str) -> None:
    """Make ``name`` the current database (qualified names are preferred)."""
    spark.catalog.setCurrentDatabase(name)


@contextmanager
def using_database(spark: SparkSession, name: str) -> Iterator[str]:
    """C2 for a block of statements with unqualified names; the previous current
    database is restored afterwards, so other work in the session is not affected."""
    previous = spark.catalog.currentDatabase()
    use_database(spark, name)
    try:
        yield name
    finally:
        use_database(spark, previous)


def create_partitioned_sales_table(spark: SparkSession, table: str, id_type: str = "int") -> str:
    """Parquet table with the four data columns and STRING partition columns
    ``category, year, month``, unless it exists; one that exists must have these columns."""
    parts = ", ".join(SALES_PARTITION_COLUMNS)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({partitioned_sales_ddl(id_type)}) USING PARQUET PARTITIONED BY ({parts})"
    )
    return table


def list_partitions(spark: SparkSession, table: str) -> DataFrame:
    """C4: one ``k=v/k=v/...`` string per partition, from the catalog (no file listing). The
    names of all partitions pass through the driver, as the catalog gives them."""
    return spark.sql(f"SHOW PARTITIONS {table}")


def partition_values(spark: SparkSession, table: str) -> DataFrame:
    """C4 as columns: the values of each partition as STRING, NULL for the folder of NULL."""
    names = list_partitions(spark, table)
    return names.select(*(folder_value(F.col("partition"), c).alias(c) for c in partition_columns(spark, table)))


def drop_partitions(spark: SparkSession, table: str, values: DataFrame) -> int:
    """Drop the partitions with the values of each row of ``values`` (all partition columns), where they exist; how many
    were named. The loop is over catalog entries, DROP_BATCH in a statement: only the driver can drop them."""

    def spec(row) -> str:
        given = row.asDict()
        return ", ".join(f"`{c}` = {'null' if v is None else quoted_text(str(v))}" for c, v in given.items())

    specs = [f"PARTITION ({spec(r)})" for r in values.collect()]
    for at in range(0, len(specs), DROP_BATCH):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs[at : at + DROP_BATCH])}")
    return len(specs)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    """Names of a table's partition columns, from the catalog."""
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Tables of a database (``namespace, tableName, isTemporary``)."""
    return spark.sql(f"SHOW TABLES IN {database}")


def file_listing(df: DataFrame, partition_cols: Sequence[str] = SALES_PARTITION_COLUMNS) -> DataFrame:
    """C6 file by file: partition values, ``file_path``, ``file_size``, ``modified``, ``rows`` of a file-backed
    DataFrame.

    Uses the hidden ``_metadata`` column, so the scan reads no data columns. Only files that
    hold rows are seen."""
    cols = list(partition_cols)
    meta = {"file_path": "file_path", "file_size": "file_size", "modified": "file_modification_time"}
    seen = df.select(*cols, *(F.col(f"_metadata.{m}").alias(c) for c, m in meta.items()))
    return seen.groupBy(*cols, "file_path").agg(
        F.max("file_size").alias("file_size"), F.max("modified").alias("modified"), F.count("*").alias("rows")
    )


def partition_files(df: DataFrame, partition_cols: Sequence[str] = SALES_PARTITION_COLUMNS) -> DataFrame:
    """Files, bytes and rows per partition of a file-backed DataFrame.

    Files are grouped first (each task sees few files, so the partial aggregate is tiny), then
    per partition."""
    cols = list(partition_cols)
    return file_listing(df, cols).groupBy(*cols).agg(
        F.count("*").alias("files"),
        F.sum("file_size").alias("bytes"),
        F.sum("rows").alias("rows"),
    )


def table_location(spark: SparkSession, table: str) -> str:
    """Storage folder of a catalog table, from its extended description (metadata only)."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Location").select("data_type")
    return rows.first()[0]


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    """The table's own properties, from the catalog."""
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
