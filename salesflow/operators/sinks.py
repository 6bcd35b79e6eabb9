"""Table and path writers (K1-K5).

How rows reach the writer tasks of a partitioned write (``distribute``):

* ``"rebalance"`` (row-level data): one shuffle by the partition columns so each task
  writes few directories. AQE sizes the tasks by bytes, splitting a partition that holds
  a hot value (no single task gets a third of the data) and merging small ones.
* ``"spread"`` (small results with many partition values, e.g. aggregates): hash by the
  partition values into ``writers`` tasks that AQE does not merge, so thousands of
  one-file directories are written in parallel, not by one task.
* ``"none"``: the input is already clustered by the partition columns (e.g. read from a
  table partitioned by them); each task writes only the few directories it holds.

Without any of these every task writes a file into every partition value it meets.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from salesflow.operators.catalog import file_listing, partition_columns

DYNAMIC_OVERWRITE_CONF = "spark.sql.sources.partitionOverwriteMode"
DISTRIBUTIONS = ("rebalance", "spread", "none")


def rebalance(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Hash-distribute by ``cols`` for a partitioned write, splitting skewed partitions."""
    return df.hint("rebalance", *cols) if cols else df


def spread(df: DataFrame, cols: Sequence[str], writers: int | None = None) -> DataFrame:
    """Hash-distribute a small result by its partition values over ``writers`` tasks (default: the
    session's shuffle width).

    The key is a hash of the values, not the columns themselves: a repartition on the
    same columns as a preceding aggregate is dropped by the planner, leaving the
    aggregate's shuffle, which AQE merges into one task for a small result. A
    repartition with a fixed count is never merged, and equal values share a task."""
    if not cols:
        return df
    width = writers or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(width, F.xxhash64(*cols))


def distribute(df: DataFrame, cols: Sequence[str], how: str, writers: int | None = None) -> DataFrame:
    """Apply one of ``DISTRIBUTIONS`` for a write partitioned by ``cols``; ``writers`` is for "spread"."""
    if how not in DISTRIBUTIONS:
        raise ValueError(f"distribute must be one of {DISTRIBUTIONS}, got {how!r}")
    if how == "rebalance":
        return rebalance(df, cols)
    if how == "spread":
        return spread(df, cols, writers)
    return df


def _in_table_order(df: DataFrame, table: str) -> DataFrame:
    # INSERT is positional; select the table's columns by name so order never matters.
    return df.select(*df.sparkSession.table(table).columns)


def insert_into(df: DataFrame, table: str, distribute_by: str = "rebalance") -> None:
    """K1: append into an existing (partitioned) table; partition values come from the rows.
    Appending the same rows twice keeps both copies."""
    rows = distribute(df, partition_columns(df.sparkSession, table), distribute_by)
    _in_table_order(rows, table).write.insertInto(table, overwrite=False)


def save_table(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    distribute_by: str = "rebalance",
    writers: int | None = None,
) -> None:
    """K2/K3/K4: write a managed Parquet table. With ``mode='overwrite'`` the whole table is
    replaced, including partitions absent from ``df`` (whatever partitionOverwriteMode says).
    ``distribute_by`` picks how rows reach the writers (see the module notes); it only
    applies to partitioned writes."""
    cols = list(partition_by)
    writer = distribute(df, cols, distribute_by, writers).write.mode(mode).format("parquet")
    if cols:
        writer = writer.partitionBy(*cols)
    writer.saveAsTable(table)


def session_like(spark: SparkSession) -> SparkSession:
    """A session of its own with the settings and current database of ``spark``."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if other.conf.isModifiable(key):
            other.conf.set(key, value)
    other.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return other


def overwrite_partitions(
    df: DataFrame, table: str, distribute_by: str = "rebalance", writers: int | None = None
) -> None:
    """K5: replace only the partitions present in ``df``; other partitions stay.

    An insert honours only the session setting, so it runs in a session of its own, where the
    rows are reached through a global temporary view: other writes of this session keep theirs."""
    spark = df.sparkSession
    rows = distribute(df, partition_columns(spark, table), distribute_by, writers)
    name = f"salesflow_rows_{uuid.uuid4().hex}"
    _in_table_order(rows, table).createGlobalTempView(name)
    try:
        other = session_like(spark)
        other.conf.set(DYNAMIC_OVERWRITE_CONF, "dynamic")
        other.sql(f"INSERT OVERWRITE TABLE {table} SELECT * FROM global_temp.{name}")
    finally:
        spark.catalog.dropGlobalTempView(name)
    spark.catalog.refreshTable(table)


def overwrite_path_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], distribute_by: str = "rebalance"
) -> None:
    """K5 for a path: the per-write option is honoured by path writes."""
    cols = list(partition_by)
    (
        distribute(df, cols, distribute_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*cols)
        .parquet(path)
    )


def row_bytes(df: DataFrame) -> Column:
    """About the bytes that a row of ``df`` takes in a sort: its fields, texts and nested values, and its place in the order."""
    size = F.lit(32 + 8 * len(df.columns)).cast("bigint")
    for field in df.schema:
        if isinstance(field.dataType, (ArrayType, MapType, StructType)):
            size += F.coalesce(F.octet_length(F.col(field.name).cast("string")), F.lit(0))
        elif isinstance(field.dataType, (StringType, BinaryType)):
            size += F.coalesce(F.octet_length(field.name), F.lit(0))
    return size


def save_sorted(
    df: DataFrame,
    table: str,
    sort_by: Sequence[str],
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    writers: int | None = None,
    target_bytes: int = 128 << 20,
) -> None:
    """K3/K4 with the reference's sort (O1/O2) kept in the files: every file holds one range of ``sort_by`` (within its
    partition), in order, so a filter on the keys passes over the files and row groups outside it.

    Rows are dealt by ranges of the keys to ``writers`` tasks (default: the session's shuffle width), or to more, so that
    each sorts about ``target_bytes`` however many rows there are; for that the rows are measured first, all of them. A key
    that holds more rows than a range is cut by a hash of the other columns: then neighbouring files share that one value,
    no task gets all of it. Readers that want an order still sort: files are read in any order."""
    least = writers or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = max(least, -(-(df.agg(F.sum(row_bytes(df))).first()[0] or 0) // target_bytes))
    keys = [*partition_by, *sort_by]
    rest = [c for c in df.columns if c not in keys]
    ranges = [*keys, F.xxhash64(*rest)] if rest else keys
    writer = df.repartitionByRange(width, *ranges).sortWithinPartitions(*keys).write.mode(mode).format("parquet")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)


def file_bins(files: DataFrame, partition_by: Sequence[str], target_bytes: int) -> DataFrame:
    """The files of each partition that has more than its bytes need, packed into bins of about ``target_bytes``:
    ``file_path, bin``. Files are laid end to end by falling size and cut at every multiple of the target."""
    of = Window.partitionBy(*partition_by)
    laid = of.orderBy(F.desc("file_size"), "file_path").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    packed = files.withColumns(
        {
            "bin": F.floor((F.sum("file_size").over(laid) - F.col("file_size")) / target_bytes),
            "needed": F.ceil(F.sum("file_size").over(of) / target_bytes),
            "found": F.count("*").over(of),
        }
    )
    return packed.where("found > greatest(needed, 1)").select(*partition_by, "file_path", "bin")


def compact_table(spark: SparkSession, table: str, target_bytes: int = 128 << 20) -> int:
    """Rewrite the partitions that have more files than their bytes need, each replaced as a whole (K5), rows unchanged;
    how many partitions. Readers of a partition see its old files or its new ones.

    A bin's rows go to one task, one of as many as there are bins, and become one file; where two bins of a partition meet
    in a task, they share it. Partitions that have no file too many are not read again."""
    cols = partition_columns(spark, table)
    if not cols:
        raise ValueError(f"{table} has no partitions to replace one by one")
    spark.catalog.refreshTable(table)
    rows = spark.table(table).withColumn("_file", F.col("_metadata.file_path"))
    bins = file_bins(file_listing(spark.table(table), cols), cols, target_bytes).checkpoint()
    count, n_bins = bins.select(*cols).distinct().count(), bins.select(*cols, "bin").distinct().count()
    if count:
        placed = rows.join(bins.select(F.col("file_path").alias("_file"), F.col("bin").alias("_bin")), "_file")
        overwrite_partitions(placed.repartition(n_bins, *cols, "_bin").drop("_file", "_bin"), table, distribute_by="none")
    return count
