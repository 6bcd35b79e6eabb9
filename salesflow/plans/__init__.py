"""End-to-end jobs composed from sources, operators and sinks (L1-L4)."""

from salesflow.plans.aggregate_job import aggregate_sales, run_aggregate_job
from salesflow.plans.etl import EtlTables, category_report, extract, load, monthly_report, run_etl, transform
from salesflow.plans.incremental_etl import IncrementalRun, changed_partitions, run_incremental_etl, source_manifest
from salesflow.plans.inspection import TableReport, inspect_table
from salesflow.plans.load import (
    LoadedTables,
    append_staging,
    load_partitioned,
    loaded_partitions,
    stage_sales,
    verify_load,
)
from salesflow.plans.ledger import LedgerTables, drop_failed_loads, load_once, loaded_files
from salesflow.plans.publish import publish_etl, published_tables
from salesflow.plans.rejects import CheckedTables, load_checked, reject_reason, reject_summary

__all__ = [
    "CheckedTables",
    "load_checked",
    "reject_reason",
    "reject_summary",
    "IncrementalRun",
    "LedgerTables",
    "changed_partitions",
    "drop_failed_loads",
    "load_once",
    "loaded_files",
    "publish_etl",
    "published_tables",
    "run_incremental_etl",
    "source_manifest",
    "EtlTables",
    "LoadedTables",
    "TableReport",
    "aggregate_sales",
    "append_staging",
    "category_report",
    "extract",
    "inspect_table",
    "load",
    "load_partitioned",
    "loaded_partitions",
    "monthly_report",
    "run_aggregate_job",
    "run_etl",
    "stage_sales",
    "transform",
    "verify_load",
]
