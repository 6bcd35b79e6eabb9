"""Registered queries: one per operator group of the inventory, over the test tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame. All read the whole
``lineitem`` and ``part`` tables through the adapter, so their work grows with the
data. Queries that write use a fresh database and folder under the shared
checkpoint root (``spark.checkpoint.dir``), never the working directory.

Measures that sum or average doubles are rounded to cents in the compared form
only (the sum of doubles depends on the order of addition); the library keeps them
unrounded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesflow.functions import round_money, title_case
from salesflow.operators import (
    StepCounts,
    clean_sales,
    compact_table,
    describe_table,
    drop_partitions,
    exact_mean,
    exact_sum,
    exact_totals,
    file_listing,
    first_rows,
    insert_into,
    list_partitions,
    list_tables,
    merged_totals,
    overwrite_partitions,
    overwrite_path_partitions,
    partition_balance,
    partition_files,
    partition_values,
    row_count,
    save_sorted,
    save_table,
    table_location,
    whole_partition_balance,
    with_date_parts,
    with_partition_values,
)
from salesflow.plans import (
    EtlTables,
    LoadedTables,
    append_staging,
    category_report,
    inspect_table,
    load_checked,
    load_once,
    load_partitioned,
    monthly_report,
    publish_etl,
    published_tables,
    run_aggregate_job,
    run_etl,
    run_incremental_etl,
    stage_sales,
    verify_load,
)
from salesflow.schema import SALES_PARTITION_COLUMNS
from salesflow.session import scratch_database, scratch_location
from salesflow.streaming import read_incremental_output, run_incremental_load
from salesflow.sources import (
    ADAPTER_ID_TYPE,
    PARTITION_PATTERN,
    create_external_table,
    read_partitioned,
    read_table,
    sales_from_tpch,
)
from salesflow.sources.listing import data_files, list_folder

# Band thresholds for the compared queries. With the reference's 1000 / 300 every
# test row is premium or mid (59,955 / 45 / 0 at sf0.01); these split all three bands.
TEST_PREMIUM_FROM = 60000.0
TEST_MID_FROM = 20000.0
# Partitions from this year on are rewritten by the overwrite queries.
REWRITE_FROM_YEAR = "1999"
REWRITE_FROM_DAY = "1999-01-01"

SALES_COLUMNS = ["id", "sale_date", "product", "amount", "category"]

Query = Callable[[SparkSession, str], DataFrame]


def sales(spark: SparkSession, sf_dir: str, first_day: str | None = None) -> DataFrame:
    return sales_from_tpch(spark, sf_dir, first_day)


def _staged(spark: SparkSession, sf_dir: str) -> str:
    return stage_sales(sales(spark, sf_dir), scratch_location(spark, "staging"), ADAPTER_ID_TYPE)


def _loaded(spark: SparkSession, sf_dir: str) -> LoadedTables:
    """L1 into a fresh database: staging files, external table, partitioned table."""
    return load_partitioned(spark, scratch_database(spark), _staged(spark, sf_dir), id_type=ADAPTER_ID_TYPE)


def _etl(spark: SparkSession, sf_dir: str) -> EtlTables:
    """L1 then L3 over the loaded table's files."""
    loaded = _loaded(spark, sf_dir)
    root = table_location(spark, loaded.partitioned_table)
    return run_etl(
        spark,
        root,
        loaded.database,
        id_type=ADAPTER_ID_TYPE,
        premium_from=TEST_PREMIUM_FROM,
        mid_from=TEST_MID_FROM,
    )


# --- sources ---------------------------------------------------------------


def sales_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales rows."""
    return sales(spark, sf_dir)


def sales_external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging files, an external table over them, a full scan."""
    location = _staged(spark, sf_dir)
    table = f"{scratch_database(spark)}.sales_staging"
    create_external_table(spark, table, location, ADAPTER_ID_TYPE)
    return read_table(spark, table)


def sales_partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wildcard read of the loaded files; year and month as INT."""
    loaded = _loaded(spark, sf_dir)
    root = table_location(spark, loaded.partitioned_table)
    return read_partitioned(spark, root, id_type=ADAPTER_ID_TYPE, pattern=PARTITION_PATTERN)


def sales_partition_scan_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 with STRING partition columns: month keeps its zero padding."""
    loaded = _loaded(spark, sf_dir)
    root = table_location(spark, loaded.partitioned_table)
    return read_partitioned(spark, root, id_type=ADAPTER_ID_TYPE, integer_dates=False)


def sales_partition_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 by partition discovery of the root (no wildcard): the same rows and types."""
    loaded = _loaded(spark, sf_dir)
    root = table_location(spark, loaded.partitioned_table)
    return read_partitioned(spark, root, id_type=ADAPTER_ID_TYPE)


def sales_table_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count of the loaded table through the catalog reader."""
    return row_count(read_table(spark, _loaded(spark, sf_dir).partitioned_table))


# --- transforms and aggregates --------------------------------------------


def sales_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1, P3, F1, F3-F5."""
    return with_date_parts(sales(spark, sf_dir))


def sales_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2, F6, P5, P6, F7."""
    return clean_sales(sales(spark, sf_dir), TEST_PREMIUM_FROM, TEST_MID_FROM)


def sales_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G5."""
    return row_count(sales(spark, sf_dir))


def sales_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rows, deterministic by ordering on every column."""
    return first_rows(sales(spark, sf_dir), 3, order_by=SALES_COLUMNS)


def sales_aggregated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: G2 written with K2 (partitioned overwrite), read back by column name."""
    table = run_aggregate_job(sales(spark, sf_dir), f"{scratch_database(spark)}.sales_aggregated")
    return read_table(spark, table).withColumns(
        {"total_amount": round_money("total_amount"), "avg_amount": round_money("avg_amount")}
    )


def sales_aggregated_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 with ``overwrite="partitions"``: a re-run over the rows from REWRITE_FROM_YEAR on
    replaces those partitions only; the earlier ones stay."""
    table = f"{scratch_database(spark)}.sales_aggregated"
    run_aggregate_job(sales(spark, sf_dir), table, overwrite="partitions")
    run_aggregate_job(sales(spark, sf_dir, REWRITE_FROM_DAY), table, overwrite="partitions")
    return read_table(spark, table).withColumns(
        {"total_amount": round_money("total_amount"), "avg_amount": round_money("avg_amount")}
    )


# --- partitioned load (L1) -------------------------------------------------


def sales_partitioned_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every staging row in its (category, year, month) partition."""
    return read_table(spark, _loaded(spark, sf_dir).partitioned_table)


def sales_load_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 with ``replace_partitions``, run twice over the same staging files: one copy stays."""
    staging, database = _staged(spark, sf_dir), scratch_database(spark)
    for _ in range(2):
        tables = load_partitioned(spark, database, staging, id_type=ADAPTER_ID_TYPE, replace_partitions=True)
    return read_table(spark, tables.partitioned_table)


def sales_partition_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1, O2: the load's verification aggregate."""
    out = verify_load(spark, _loaded(spark, sf_dir).partitioned_table)
    return out.withColumn("revenue", round_money("revenue"))


def sales_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 twice: both copies of every row stay."""
    loaded = _loaded(spark, sf_dir)
    append_staging(spark, loaded)
    return read_table(spark, loaded.partitioned_table)


def sales_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4."""
    return list_partitions(spark, _loaded(spark, sf_dir).partitioned_table)


def sales_load_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 twice into one database, from two staging folders that together hold every row."""
    rows, database = sales(spark, sf_dir), scratch_database(spark)
    for part in (0, 1):
        batch = rows.where(F.pmod("id", F.lit(2)) == part)
        staging = stage_sales(batch, scratch_location(spark, "staging"), ADAPTER_ID_TYPE)
        tables = load_partitioned(spark, database, staging, id_type=ADAPTER_ID_TYPE)
    return read_table(spark, tables.partitioned_table)


def sales_restage_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 from one folder three times: as staged first, with files added, and staged anew. Each load replaces the
    partitions it meets, so what is there last is one copy of every row."""
    rows, database = sales(spark, sf_dir), scratch_database(spark)
    staging = stage_sales(rows.where(F.pmod("id", F.lit(2)) == 0), scratch_location(spark, "staging"), ADAPTER_ID_TYPE)
    load = lambda: load_partitioned(spark, database, staging, id_type=ADAPTER_ID_TYPE, replace_partitions=True)
    load()
    rows.where(F.pmod("id", F.lit(2)) == 1).write.mode("append").parquet(staging)
    load()
    stage_sales(rows, staging, ADAPTER_ID_TYPE)
    return read_table(spark, load().partitioned_table)


def sales_partition_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per partition, and whether its files and bytes were found (their numbers depend on the layout)."""
    found = partition_files(read_table(spark, _loaded(spark, sf_dir).partitioned_table))
    return found.select(
        "category", "year", "month", "rows", (F.col("files") >= 1).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes")
    )


def sales_file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C6 file by file, summed up: rows over all files, and whether every file has a size, a time and a path of its own."""
    files = file_listing(read_table(spark, _loaded(spark, sf_dir).partitioned_table))
    return files.agg(
        F.sum("rows").alias("rows"),
        F.count_distinct("category", "year", "month").alias("partitions"),
        F.bool_and((F.col("file_size") > 0) & F.col("modified").isNotNull()).alias("described"),
        (F.count_distinct("file_path") == F.count("*")).alias("paths_differ"),
    )


def sales_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column names and types (the partition columns are described twice)."""
    described = describe_table(spark, _loaded(spark, sf_dir).partitioned_table)
    return described.where("col_name NOT LIKE '#%'").select("col_name", "data_type").distinct()


def sales_partition_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4: the rows of all Spark partitions of the table scan, and whether each partition is listed once."""
    balance = partition_balance(read_table(spark, _loaded(spark, sf_dir).partitioned_table))
    return balance.agg(
        F.sum("rows").alias("total_rows"), (F.count("*") == F.count_distinct("partition_id")).alias("ids_differ")
    )


def sales_inspection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4: the table's count, columns, number of partitions and ordered sample, one row for each finding."""
    report = inspect_table(spark, _loaded(spark, sf_dir).partitioned_table, ordered_sample=True)
    row = lambda part, value: (F.lit(part).alias("part"), value.cast("string").alias("value"))
    columns = report.row_count.select(F.explode(F.array(*map(F.lit, report.columns))).alias("c"))
    return (
        report.row_count.select(*row("row_count", F.col("row_count")))
        .unionByName(columns.select(*row("column", F.col("c"))))
        .unionByName(report.partitions.agg(F.count("*").alias("n")).select(*row("partitions", F.col("n"))))
        .unionByName(report.balance.agg(F.sum("rows").alias("n")).select(*row("balance", F.col("n"))))
        .unionByName(report.sample.select(*row("sample", F.concat_ws("|", "id", "sale_date", "product", "category", "year", "month"))))
    )


def sales_stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 as a stream: staging files loaded file by file into the partitioned layout, once each."""
    staging = _staged(spark, sf_dir)
    out = scratch_location(spark, "stream-out")
    run_incremental_load(
        spark, staging, out, scratch_location(spark, "stream-ckpt"), id_type=ADAPTER_ID_TYPE, files_per_batch=1
    )
    return read_incremental_output(spark, out, id_type=ADAPTER_ID_TYPE)


def sales_load_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1/L1 with a ledger: one folder loaded when half of it is there, when all of it is, and once more: one copy."""
    rows, database, staging = sales(spark, sf_dir), scratch_database(spark), scratch_location(spark, "staging")
    stage_sales(rows.where(F.pmod("id", F.lit(2)) == 0), staging, ADAPTER_ID_TYPE)
    load_once(spark, database, staging, ADAPTER_ID_TYPE)
    rows.where(F.pmod("id", F.lit(2)) == 1).write.mode("append").parquet(staging)
    for _ in range(2):
        tables = load_once(spark, database, staging, ADAPTER_ID_TYPE)
    return read_table(spark, tables.view)


def sales_folder_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C6 recursively: folders on each level of the loaded table, and whether files without rows are listed among its
    staging files (a file of none is added to them)."""
    loaded = _loaded(spark, sf_dir)
    root = table_location(spark, loaded.partitioned_table)
    folders = list_folder(spark, root).where("kind = 'folder' AND relative LIKE 'category=%'")
    levels = folders.groupBy(F.size(F.split("relative", "/")).alias("level")).agg(F.count("*").alias("folders"))
    staged = spark.read.parquet(loaded.staging_location)
    staged.limit(0).write.mode("append").parquet(loaded.staging_location)
    files = data_files(list_folder(spark, loaded.staging_location))
    with_rows = file_listing(spark.read.parquet(loaded.staging_location), ())
    return levels.crossJoin(files.agg(F.count("*").alias("listed")).crossJoin(with_rows.agg(F.count("*").alias("filled"))).select(
        (F.col("listed") > F.col("filled")).alias("empty_files_listed")))


def sales_partition_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4: eight partitions asked for, one of them with all rows."""
    rows = sales(spark, sf_dir).select(F.length("sale_date").alias("same")).repartition(8, "same")
    balance = whole_partition_balance(rows)
    return balance.agg(F.count("*").alias("partitions"), F.count_if(F.col("rows") > 0).alias("filled"), F.sum("rows").alias("total_rows"))


def sales_aggregated_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2 by exact sums: not rounded, and the same to the last bit for any division of the rows."""
    totals = exact_totals(sales(spark, sf_dir).transform(with_date_parts), SALES_PARTITION_COLUMNS).withColumn("total_amount", exact_sum())
    return totals.select(
        *SALES_PARTITION_COLUMNS, "total_amount", F.col("n_ids").alias("total_sales"), exact_mean(F.col("total_amount")).alias("avg_amount")
    )


def sales_category_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 by exact sums, rolled up from those of G1's groups."""
    totals = exact_totals(with_partition_values(sales(spark, sf_dir)), SALES_PARTITION_COLUMNS)
    merged = merged_totals(totals, ["category"]).withColumn("total_revenue", exact_sum())
    return merged.select(
        "category", F.col("n_rows").alias("total_sales"), "total_revenue", exact_mean(F.col("total_revenue")).alias("avg_amount"),
        F.col("amount_min").alias("min_amount"), F.col("amount_max").alias("max_amount"),
    )


def sales_checked_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a load whose rows have some dates spoilt; good and rejected rows with their reasons, all of them."""
    day = F.when(F.col("id") % 5 == 0, F.replace("sale_date", F.lit("-"), F.lit("/"))).when(F.col("id") % 7 != 0, F.col("sale_date"))
    staging = stage_sales(sales(spark, sf_dir).withColumn("sale_date", day), scratch_location(spark, "staging"), ADAPTER_ID_TYPE)
    tables = load_checked(spark, scratch_database(spark), staging, scratch_location(spark, "checked"), ADAPTER_ID_TYPE)
    good = read_table(spark, tables.good).withColumn("reason", F.lit(None).cast("string"))
    return good.unionByName(read_table(spark, tables.rejected))


def sales_sorted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 into K4: a table whose files hold ranges of the sale date; its rows, and whether any file reaches back into
    the range of the one before."""
    table = f"{scratch_database(spark)}.sales_sorted"
    save_sorted(sales(spark, sf_dir), table, ["sale_date"], writers=12)
    # rows are counted by day first: the least and greatest of a text, asked of the rows, would sort a task's rows by file
    days = read_table(spark, table).groupBy(F.col("_metadata.file_path").alias("file_path"), "sale_date").agg(F.count("*").alias("rows"))
    files = days.groupBy("file_path").agg(F.sum("rows").alias("rows"), F.min("sale_date").alias("first"), F.max("sale_date").alias("last"))
    before = F.lag("last").over(Window.orderBy("first", "last"))
    return files.withColumn("back", before > F.col("first")).agg(
        F.sum("rows").alias("rows"), (F.count("*") > 1).alias("several_files"), F.coalesce(F.bool_or("back"), F.lit(False)).alias("overlap")
    )


def sales_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: a table appended to in small pieces, then compacted: its rows, by category, and whether each partition is one file."""
    table = f"{scratch_database(spark)}.sales_by_year"
    rows = _by_year(spark, sf_dir)
    for part in range(3):
        save_table(rows.where(F.pmod("id", F.lit(3)) == part), table, ("category", "year"), "append" if part else "overwrite")
    compact_table(spark, table)
    files = file_listing(read_table(spark, table), ("category", "year"))
    return files.groupBy("category", "year").agg(F.sum("rows").alias("rows"), F.count("*").alias("files"))


# --- overwrite modes ---------------------------------------------------------


def _by_year(spark: SparkSession, sf_dir: str, first_day: str | None = None) -> DataFrame:
    return with_partition_values(sales(spark, sf_dir, first_day)).drop("month")


def _rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch: partitions from REWRITE_FROM_YEAR on, with title-cased products."""
    return _by_year(spark, sf_dir, REWRITE_FROM_DAY).withColumn("product", title_case("product"))


def sales_full_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2/K3: overwrite replaces the whole table; earlier partitions are gone."""
    table = f"{scratch_database(spark)}.sales_by_year"
    first = _by_year(spark, sf_dir)
    save_table(first, table, partition_by=("category", "year"))
    save_table(_rewrite(spark, sf_dir), table, partition_by=("category", "year"))
    return read_table(spark, table)


def sales_dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 on a table: only partitions present in the second batch are replaced."""
    table = f"{scratch_database(spark)}.sales_by_year"
    first = _by_year(spark, sf_dir)
    save_table(first, table, partition_by=("category", "year"))
    overwrite_partitions(_rewrite(spark, sf_dir), table)
    return read_table(spark, table)


def sales_path_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 on a path with the per-write option."""
    path = scratch_location(spark, "sales_by_year")
    first = _by_year(spark, sf_dir)
    overwrite_path_partitions(first, path, ("category", "year"))
    overwrite_path_partitions(_rewrite(spark, sf_dir), path, ("category", "year"))
    return spark.read.parquet(path).select(*SALES_COLUMNS, "year")


# --- ETL (L3) ------------------------------------------------------------------


def sales_transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3 transform written with K3 by (category, price_category)."""
    return read_table(spark, _etl(spark, sf_dir).transformed)


def sales_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3, O1, K4."""
    return category_report(spark, _etl(spark, sf_dir))


def sales_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G4, O2, K3 by (year, month)."""
    return monthly_report(spark, _etl(spark, sf_dir))


def sales_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5 + G5: every table of the ETL database with its row count. The loop runs over
    catalog entries (a handful of names); each count is a Spark job."""
    database = _etl(spark, sf_dir).database
    names = sorted(r.tableName for r in list_tables(spark, database).select("tableName").collect())
    counts = [
        row_count(read_table(spark, f"{database}.{n}")).select(F.lit(n).alias("table_name"), "row_count")
        for n in names
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


def _incremental(spark: SparkSession, sf_dir: str) -> EtlTables:
    """L3 twice over one folder: first it lacks the rows from REWRITE_FROM_YEAR on and has a category that is withdrawn
    before the second run, which reads and rewrites what changed."""
    database = scratch_database(spark)
    early = sales(spark, sf_dir).where(F.col("sale_date") < REWRITE_FROM_DAY)
    withdrawn = early.where("sale_date >= '1998-01-01'").withColumn("category", F.lit("WITHDRAWN"))
    staging = stage_sales(early.unionByName(withdrawn), scratch_location(spark, "staging"), ADAPTER_ID_TYPE)
    loaded = load_partitioned(spark, database, staging, id_type=ADAPTER_ID_TYPE)
    root = table_location(spark, loaded.partitioned_table)
    run = lambda: run_incremental_etl(spark, root, database, ADAPTER_ID_TYPE, TEST_PREMIUM_FROM, TEST_MID_FROM)
    run()
    insert_into(with_partition_values(sales(spark, sf_dir, REWRITE_FROM_DAY)), loaded.partitioned_table)
    drop_partitions(spark, loaded.partitioned_table, partition_values(spark, loaded.partitioned_table).where("category = 'WITHDRAWN'"))
    return run().tables


def sales_etl_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3 for changed partitions only: the transformed rows after the second run."""
    return read_table(spark, _incremental(spark, sf_dir).transformed)


def sales_etl_incremental_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_report(spark, _incremental(spark, sf_dir))


def sales_etl_incremental_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_report(spark, _incremental(spark, sf_dir))


def sales_etl_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3 published as one, twice; between them a run that fails. The monthly table that readers are shown."""
    loaded = _loaded(spark, sf_dir)
    root = table_location(spark, loaded.partitioned_table)
    publish = lambda source: publish_etl(spark, source, loaded.database, ADAPTER_ID_TYPE, TEST_PREMIUM_FROM, TEST_MID_FROM)
    publish(root)
    try:
        publish(f"{root}/nowhere")
    except AnalysisException:
        pass
    publish(root)
    return monthly_report(spark, published_tables(spark, loaded.database))


def sales_etl_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G5 inside L3: rows of each step, observed while the tables are written."""
    loaded, counts = _loaded(spark, sf_dir), StepCounts()
    root = table_location(spark, loaded.partitioned_table)
    run_etl(spark, root, loaded.database, ADAPTER_ID_TYPE, TEST_PREMIUM_FROM, TEST_MID_FROM, counts=counts)
    return counts.table(spark).select("step", "rows")


QUERIES: dict[str, Query] = {
    "sales_scan": sales_scan,
    "sales_external_table": sales_external_table,
    "sales_partition_scan": sales_partition_scan,
    "sales_partition_scan_text": sales_partition_scan_text,
    "sales_partition_discovery": sales_partition_discovery,
    "sales_table_count": sales_table_count,
    "sales_date_parts": sales_date_parts,
    "sales_clean": sales_clean,
    "sales_count": sales_count,
    "sales_sample": sales_sample,
    "sales_aggregated": sales_aggregated,
    "sales_aggregated_rerun": sales_aggregated_rerun,
    "sales_partitioned_load": sales_partitioned_load,
    "sales_load_rerun": sales_load_rerun,
    "sales_partition_revenue": sales_partition_revenue,
    "sales_append_twice": sales_append_twice,
    "sales_partitions": sales_partitions,
    "sales_load_two_batches": sales_load_two_batches,
    "sales_restage_load": sales_restage_load,
    "sales_partition_files": sales_partition_files,
    "sales_file_listing": sales_file_listing,
    "sales_inspection": sales_inspection,
    "sales_schema": sales_schema,
    "sales_partition_balance": sales_partition_balance,
    "sales_stream_load": sales_stream_load,
    "sales_full_overwrite": sales_full_overwrite,
    "sales_dynamic_overwrite": sales_dynamic_overwrite,
    "sales_path_overwrite": sales_path_overwrite,
    "sales_transformed": sales_transformed,
    "sales_by_category": sales_by_category,
    "sales_by_month": sales_by_month,
    "sales_tables": sales_tables,
    "sales_load_once": sales_load_once,
    "sales_folder_listing": sales_folder_listing,
    "sales_partition_count": sales_partition_count,
    "sales_aggregated_exact": sales_aggregated_exact,
    "sales_category_exact": sales_category_exact,
    "sales_etl_incremental": sales_etl_incremental,
    "sales_etl_incremental_by_category": sales_etl_incremental_by_category,
    "sales_etl_incremental_by_month": sales_etl_incremental_by_month,
    "sales_etl_published": sales_etl_published,
    "sales_etl_counts": sales_etl_counts,
    "sales_checked_load": sales_checked_load,
    "sales_sorted_table": sales_sorted_table,
    "sales_compacted": sales_compacted,
}
