"""L3 for changed partitions only (K5): what the last run read is compared with what is there now.

State, published as one generation at the end of a run: a manifest of the source's files (name, size, time, partition) and
exact totals for each source partition and price band. A run lists the source, finds the partitions whose files differ,
reads these, and merges their totals with those kept. It rewrites only the folders of the transformed table and of the
monthly table that a changed partition had or has rows in, and drops those that are left without rows. Totals are exact
sums, so the summaries equal those of a full run to the last bit.

A run that fails before its state is published is done again by the next one: the same partitions count as changed, and
every write replaces whole folders. One run at a time; a second that publishes meanwhile makes the first raise.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.functions import round_money
from salesflow.functions.names import quoted_text
from salesflow.operators import (
    create_database,
    drop_partitions,
    exact_mean,
    exact_sum,
    exact_totals,
    generation_table,
    merged_totals,
    next_generation,
    overwrite_partitions,
    published_generation,
    save_table,
    with_keys_of,
    without_keys_of,
)
from salesflow.operators.catalog import table_properties
from salesflow.plans.etl import EtlTables, etl_tables, extract, transform
from salesflow.schema import MID_FROM, MONTHLY_PARTITION_COLUMNS, PREMIUM_FROM, TRANSFORMED_PARTITION_COLUMNS
from salesflow.session import shared_root
from salesflow.sources.listing import data_files, list_folder, with_folder_values

NAME = "etl_state"
BASES = ("etl_manifest", "etl_totals", "etl_changes")
SOURCE_KEYS = ("category", "year", "month")
FILE_COLUMNS = ("relative", "size", "modified")


@dataclass(frozen=True)
class IncrementalRun:
    """The tables, the partitions that a run found changed or gone (``category, year, month, status``), and whether it
    had to do everything (first run, or other parameters than the last one's)."""

    tables: EtlTables
    changes: DataFrame
    full: bool


def source_manifest(spark: SparkSession, source_root: str) -> DataFrame:
    """The files of a ``category=/year=/month=`` folder: partition values typed as ``extract`` reads them."""
    files = with_folder_values(data_files(list_folder(spark, source_root)), SOURCE_KEYS)
    numbers = {c: F.col(c).try_cast("int") for c in ("year", "month")}
    return files.withColumns(numbers).select(*SOURCE_KEYS, *FILE_COLUMNS)


def changed_partitions(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """``category, year, month, status``: partitions with a file added, removed, resized or rewritten ('changed'), and
    those of which no file is left ('gone'). One shuffle of both manifests; NULL values are values."""
    both = new.withColumn("side", F.lit(1))
    if old is not None:
        both = both.unionByName(old.select(*new.columns).withColumn("side", F.lit(-1)))
    files = both.groupBy(*SOURCE_KEYS, *FILE_COLUMNS).agg(F.sum("side").alias("side"), F.count_if(F.col("side") > 0).alias("now"))
    parts = files.groupBy(*SOURCE_KEYS).agg(F.bool_or(F.col("side") != 0).alias("differs"), F.sum("now").alias("now"))
    status = F.when(F.col("now") == 0, "gone").otherwise("changed")
    return parts.where("differs").select(*SOURCE_KEYS, status.alias("status"))


def category_summary_of(totals: DataFrame) -> DataFrame:
    """G3 from exact totals."""
    return _summary(totals, ["category"]).select(
        "category", "total_sales", "total_revenue", "avg_amount", F.col("amount_min").alias("min_amount"), F.col("amount_max").alias("max_amount")
    )


def monthly_summary_of(totals: DataFrame) -> DataFrame:
    """G4 from exact totals."""
    return _summary(totals, ["year", "month", "category"]).select("year", "month", "category", "total_sales", "total_revenue", "avg_amount")


def _summary(totals: DataFrame, keys: list[str]) -> DataFrame:
    merged = merged_totals(totals, keys).withColumn("total", exact_sum())
    return merged.withColumns({
        "total_sales": F.col("n_rows"), "total_revenue": round_money("total"), "avg_amount": round_money(exact_mean(F.col("total"))),
    })


def run_incremental_etl(
    spark: SparkSession,
    source_root: str,
    database: str,
    id_type: str = "int",
    premium_from: float = PREMIUM_FROM,
    mid_from: float = MID_FROM,
    writers: int | None = None,
) -> IncrementalRun:
    """Bring the three tables of ``database`` up to date with the source. Nothing is written where no file differs.
    Other bands, another id type or another source than the last run's make everything count as changed."""
    create_database(spark, database)
    shared_root(spark)
    tables = etl_tables(database)
    label = published_generation(spark, database, NAME)
    settings = f"{source_root.rstrip('/')} {id_type} {premium_from!r} {mid_from!r}"
    there = [spark.catalog.tableExists(t) for t in (tables.transformed, tables.by_category, tables.by_month)]
    known = label is not None and all(there)
    if known:
        state = {b: generation_table(database, b, label) for b in BASES}
        known = table_properties(spark, state["etl_manifest"]).get("salesflow.settings") == settings
    manifest = source_manifest(spark, source_root).checkpoint()
    old = spark.table(state["etl_manifest"]) if known else None
    changes = changed_partitions(old, manifest).checkpoint()
    if known and changes.isEmpty():
        return IncrementalRun(tables, changes, False)

    rows = extract(spark, source_root, id_type)
    with next_generation(spark, database, NAME, BASES) as made:
        names = {b: made.table(b) for b in BASES}
        save_table(manifest, names["etl_manifest"])
        spark.sql(f"ALTER TABLE {names['etl_manifest']} SET TBLPROPERTIES ('salesflow.settings' = {quoted_text(settings)})")
        save_table(changes, names["etl_changes"])
        changes = spark.table(names["etl_changes"])
        read = rows if not known else with_keys_of(rows, changes.where("status = 'changed'"), SOURCE_KEYS)
        fresh = exact_totals(transform(read, premium_from, mid_from), [*SOURCE_KEYS, "price_category"])
        kept = without_keys_of(spark.table(state["etl_totals"]), changes, SOURCE_KEYS) if known else None
        save_table(fresh if kept is None else kept.unionByName(fresh), names["etl_totals"])
        totals = spark.table(names["etl_totals"])

        if not known:
            save_table(transform(rows, premium_from, mid_from), tables.transformed, TRANSFORMED_PARTITION_COLUMNS)
            months = monthly_summary_of(totals)
            save_table(months, tables.by_month, MONTHLY_PARTITION_COLUMNS, distribute_by="spread", writers=writers)
        else:
            touched = with_keys_of(spark.table(state["etl_totals"]).select(*SOURCE_KEYS, "price_category"), changes, SOURCE_KEYS)
            touched = touched.unionByName(with_keys_of(totals.select(*touched.columns), changes, SOURCE_KEYS))
            folders = touched.select(*TRANSFORMED_PARTITION_COLUMNS).distinct().checkpoint()
            again = transform(with_keys_of(rows, folders, ["category"]), premium_from, mid_from)
            overwrite_partitions(with_keys_of(again, folders, TRANSFORMED_PARTITION_COLUMNS), tables.transformed)
            drop_partitions(spark, tables.transformed, without_keys_of(folders, totals, TRANSFORMED_PARTITION_COLUMNS))
            months = changes.select(*MONTHLY_PARTITION_COLUMNS).distinct().checkpoint()
            of_months = with_keys_of(totals, months, MONTHLY_PARTITION_COLUMNS)
            overwrite_partitions(monthly_summary_of(of_months), tables.by_month, distribute_by="spread", writers=writers)
            drop_partitions(spark, tables.by_month, without_keys_of(months, totals, MONTHLY_PARTITION_COLUMNS))
        save_table(category_summary_of(totals), tables.by_category)
    return IncrementalRun(tables, spark.table(names["etl_changes"]), not known)
