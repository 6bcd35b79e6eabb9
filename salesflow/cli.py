"""Command-line jobs: the reference's scripts as ``python -m salesflow <job>``.

    load       staging Parquet folder -> external staging table -> partitioned table (L1)
    aggregate  staging Parquet folder -> aggregate table by category, year, month (L2)
    etl        partitioned sales folder -> transformed, by-category, by-month tables (L3)
    inspect    catalog table -> count, schema, partitions, sample (L4)

The session comes from the environment (``spark-submit`` or spark-defaults). Every result is
kept whole in a table (or, for ``inspect``, in Parquet folders under ``--out``); what is printed
after the writes is its row count and its first ``--show`` rows.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from salesflow.operators import file_listing, partition_revenue, save_table, sort_rows
from salesflow.plans import (
    category_report,
    inspect_table,
    load_partitioned,
    loaded_partitions,
    monthly_report,
    run_aggregate_job,
    run_etl,
)
from salesflow.schema import MID_FROM, PREMIUM_FROM, raw_sales_schema
from salesflow.sources import PARTITION_PATTERN


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m salesflow", description=__doc__.split("\n\n")[0])
    p.add_argument("--master", help="Spark master; default: from the environment")
    p.add_argument("--id-type", choices=["int", "bigint"], default="int")
    p.add_argument("--show", type=int, default=20, help="rows of each result to print as a sample")
    sub = p.add_subparsers(dest="job", required=True)

    load = sub.add_parser("load", help="L1: partitioned load from a staging folder")
    load.add_argument("--staging", required=True, help="folder of staging Parquet files")
    load.add_argument("--database", default="sales")
    load.add_argument("--replace-partitions", action="store_true", help="replace the loaded partitions, do not append")

    agg = sub.add_parser("aggregate", help="L2: aggregate table by category, year, month")
    agg.add_argument("--staging", required=True, help="folder of staging Parquet files")
    agg.add_argument("--table", default="default.sales_aggregated")
    agg.add_argument("--overwrite", choices=["table", "partitions"], default="table")

    etl = sub.add_parser("etl", help="L3: transformed, by-category and by-month tables")
    etl.add_argument("--source", required=True, help="root of the category=/year=/month= folders")
    etl.add_argument("--database", default="sales_etl")
    etl.add_argument("--premium-from", type=float, default=PREMIUM_FROM)
    etl.add_argument("--mid-from", type=float, default=MID_FROM)
    etl.add_argument("--wildcard", action="store_true", help="read the folders by the wildcard, not partition discovery")

    ins = sub.add_parser("inspect", help="L4: count, schema, partitions, sample")
    ins.add_argument("--table", required=True)
    ins.add_argument("--sample", type=int, default=3)
    ins.add_argument("--out", help="folder for the whole report, one Parquet folder a part")
    return p


def _print(name: str, df: DataFrame, rows: int) -> None:
    total = df.count()
    print(f"{name}: {total} rows" + (f", the first {rows} of them" if total > rows else ""))
    df.show(rows, truncate=False)


def _keep(spark: SparkSession, table: str, df: DataFrame, rows: int, order: Sequence[str]) -> str:
    """Write a result whole, then print a sample of it."""
    save_table(df, table)
    _print(table, sort_rows(spark.table(table), *order), rows)
    return table


def run(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Run one job; returns what it made (table names or the report)."""
    if args.job == "load":
        tables = load_partitioned(
            spark, args.database, args.staging, id_type=args.id_type, replace_partitions=args.replace_partitions
        )
        loaded, db = tables.partitioned_table, args.database
        reports = [
            _keep(spark, f"{db}.load_partitions", loaded_partitions(spark, loaded), args.show, ["partition"]),
            _keep(spark, f"{db}.load_check", partition_revenue(spark.table(loaded)), args.show, ["year", "month", "category"]),
            _keep(spark, f"{db}.load_files", file_listing(spark.table(loaded)), args.show, ["file_path"]),
        ]
        return {"tables": tables, "reports": reports}
    if args.job == "aggregate":
        raw = spark.read.schema(raw_sales_schema(args.id_type)).parquet(args.staging)
        table = run_aggregate_job(raw, args.table, overwrite=args.overwrite)
        _print(table, spark.table(table), args.show)
        return {"table": table}
    if args.job == "etl":
        tables = run_etl(
            spark,
            args.source,
            args.database,
            id_type=args.id_type,
            premium_from=args.premium_from,
            mid_from=args.mid_from,
            pattern=PARTITION_PATTERN if args.wildcard else None,
        )
        _print(tables.by_category, category_report(spark, tables), args.show)
        _print(tables.by_month, monthly_report(spark, tables), args.show)
        return {"tables": tables}
    report = inspect_table(spark, args.table, sample_size=args.sample)
    print(report.schema_tree)
    parts = {"row_count": report.row_count, "schema": report.schema, "partitions": report.partitions}
    parts |= {"balance": report.balance, "sample": report.sample}
    for name, df in parts.items():
        if df is not None and args.out:
            df.write.mode("overwrite").parquet(f"{args.out}/{name}")
            df = spark.read.parquet(f"{args.out}/{name}")
        if df is not None:
            _print(name, df, df.count() if name == "schema" else args.show)
    return {"report": report}


def main(argv: Sequence[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    builder = SparkSession.builder.appName(f"salesflow-{args.job}")
    if args.master:
        builder = builder.master(args.master)
    return run(builder.getOrCreate(), args)
