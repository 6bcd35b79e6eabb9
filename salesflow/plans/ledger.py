"""L1 that knows what it has loaded (K1): a ledger of staging files, committed with their rows.

Every load writes its rows under a load id, the last partition column, so that no file of an earlier load is touched.
Then it writes its files into the ledger, and last one row into the table of loads, as one file: that row commits the
load. Readers use a view that shows the rows of committed loads only. A load that fails, wherever it does, shows nothing;
the next one finds the same files not loaded and loads them under a new id, and ``drop_failed_loads`` takes away what the
failed one left. Loading the same folder again loads the files that are new, and rewrites no partition.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.operators import (
    create_database,
    drop_partitions,
    insert_into,
    partition_values,
    with_keys_of,
    with_partition_values,
    without_keys_of,
)
from salesflow.schema import SALES_PARTITION_COLUMNS, partitioned_sales_ddl, raw_sales_schema
from salesflow.session import shared_root
from salesflow.sources.listing import data_files, list_folder

FILE_COLUMNS = ("path", "size", "modified")


@dataclass(frozen=True)
class LedgerTables:
    database: str
    #: What readers use: the columns of the partitioned table, rows of committed loads.
    view: str
    rows: str
    files: str
    loads: str


def ledger_tables(database: str, name: str = "sales_partitioned") -> LedgerTables:
    return LedgerTables(database, *(f"{database}.{name}{end}" for end in ("", "_rows", "_files", "_loads")))


def create_ledger_tables(spark: SparkSession, database: str, name: str = "sales_partitioned", id_type: str = "int") -> LedgerTables:
    """The three tables and the view over them, unless they exist."""
    create_database(spark, database)
    t = ledger_tables(database, name)
    parts = ", ".join(SALES_PARTITION_COLUMNS)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {t.rows} ({partitioned_sales_ddl(id_type)}, load_id STRING) USING PARQUET "
        f"PARTITIONED BY ({parts}, load_id)"
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {t.files} (path STRING, size BIGINT, modified TIMESTAMP, load_id STRING) USING PARQUET "
        "PARTITIONED BY (load_id)"
    )
    spark.sql(f"CREATE TABLE IF NOT EXISTS {t.loads} (load_id STRING, started TIMESTAMP, n_files BIGINT) USING PARQUET")
    columns = ", ".join(f"r.{c.split()[0]}" for c in partitioned_sales_ddl(id_type).split(", "))
    spark.sql(f"CREATE VIEW IF NOT EXISTS {t.view} AS SELECT {columns} FROM {t.rows} r LEFT SEMI JOIN {t.loads} l ON r.load_id = l.load_id")
    return t


def loaded_files(spark: SparkSession, tables: LedgerTables) -> DataFrame:
    """``path, size, modified, load_id`` of the files of committed loads."""
    return with_keys_of(spark.table(tables.files), spark.table(tables.loads), ["load_id"])


def new_files(spark: SparkSession, tables: LedgerTables, staging_location: str) -> DataFrame:
    """The staging files that no committed load holds. A path that was loaded with another size or time was rewritten in
    place: its old rows can't be told from the others, so that raises ValueError."""
    there = data_files(list_folder(spark, staging_location)).select(*FILE_COLUMNS)
    known = loaded_files(spark, tables)
    found = without_keys_of(there, known, FILE_COLUMNS).checkpoint()
    rewritten = with_keys_of(found, known, ["path"]).select("path").limit(3).collect()
    if rewritten:
        raise ValueError(f"loaded before, and changed since: {[r.path for r in rewritten]}; load with replace_partitions instead")
    return found


def load_once(
    spark: SparkSession, database: str, staging_location: str, id_type: str = "int", name: str = "sales_partitioned"
) -> LedgerTables:
    """Append the rows of the staging files that are not loaded yet. The paths of the new files pass through the driver,
    as those of any scan do; rows, ledger and commit are Spark writes. One loader at a time."""
    shared_root(spark)  # checkpoint() needs the session's checkpoint folder to be set
    tables = create_ledger_tables(spark, database, name, id_type)
    found = new_files(spark, tables, staging_location)
    paths = [r.path for r in found.select("path").collect()]
    if not paths:
        return tables
    started = datetime.now(timezone.utc)
    load_id = f"{started:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"
    rows = spark.read.schema(raw_sales_schema(id_type)).parquet(*paths)
    insert_into(with_partition_values(rows).withColumn("load_id", F.lit(load_id)), tables.rows)
    insert_into(found.withColumn("load_id", F.lit(load_id)), tables.files)
    commit = spark.range(1).select(F.lit(load_id).alias("load_id"), F.lit(started).alias("started"), F.lit(len(paths)).cast("long").alias("n_files"))
    commit.coalesce(1).write.insertInto(tables.loads)  # one row, one file: there or not
    return tables


def drop_failed_loads(spark: SparkSession, tables: LedgerTables, older_than: timedelta = timedelta(days=1)) -> list[str]:
    """Drop the partitions of loads that were never committed and began more than ``older_than`` ago (a younger one may
    still be running); their ids. Loops over catalog entries."""
    shared_root(spark)
    before = f"{datetime.now(timezone.utc) - older_than:%Y%m%dT%H%M%S}"
    committed, dropped = spark.table(tables.loads), set()
    for table in (tables.rows, tables.files):
        failed = without_keys_of(partition_values(spark, table).where(F.col("load_id") < before), committed, ["load_id"]).checkpoint()
        dropped |= {r.load_id for r in failed.select("load_id").distinct().collect()}
        drop_partitions(spark, table, failed)
    return sorted(dropped)
