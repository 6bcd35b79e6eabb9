"""Catalog table sources: external staging table (S3) and table reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from salesflow.functions.names import quoted_text
from salesflow.schema import raw_sales_ddl, raw_sales_schema


def check_columns(spark: SparkSession, table: str, wanted: StructType) -> None:
    """Raise if an existing table does not have the wanted columns (``IF NOT EXISTS`` keeps the old ones silently)."""
    have = [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in wanted.fields]
    if have != want:
        raise ValueError(f"table {table} exists with columns {have}, not {want}")


def table_type(spark: SparkSession, table: str) -> str | None:
    """``EXTERNAL``, ``MANAGED``, ``VIEW`` or ``TEMPORARY`` for what a name stands for; None where it is free."""
    return spark.catalog.getTable(table).tableType if spark.catalog.tableExists(table) else None


def create_external_table(spark: SparkSession, table: str, location: str, id_type: str = "int") -> DataFrame:
    """S3: a staging table over existing Parquet files. The files are not copied and
    dropping the table leaves them in place. ``USING PARQUET`` works with and without
    Hive support.

    An external table that exists is pointed at ``location``, and must have the declared columns. The
    file listing is refreshed, so files added or replaced since the last read are seen.

    A managed table or a view of that name raises ValueError and stays as it is: a managed table
    owns its folder, so pointed at the staging files it would take them with it when dropped."""
    kind = table_type(spark, table)
    if kind not in (None, "EXTERNAL"):
        raise ValueError(f"{table} exists and is {kind}, not an external table; its folder can't be changed safely")
    if kind:
        check_columns(spark, table, raw_sales_schema(id_type))
        spark.sql(f"ALTER TABLE {table} SET LOCATION {quoted_text(location)}")
    else:
        spark.sql(f"CREATE TABLE {table} ({raw_sales_ddl(id_type)}) USING PARQUET LOCATION {quoted_text(location)}")
    spark.sql(f"REFRESH TABLE {table}")
    return spark.table(table)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """Full scan of a catalog table (``SELECT * FROM t``). Lazy: filters and
    column choices made later are pushed into the scan, and partition filters prune directories."""
    return spark.table(table)
