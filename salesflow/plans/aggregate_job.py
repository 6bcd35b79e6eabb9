"""L2: sales rows -> date parts -> aggregate -> table partitioned by category, year, month."""

from __future__ import annotations

from pyspark.sql import DataFrame

from salesflow.operators import overwrite_partitions, sales_aggregate, save_table, with_date_parts
from salesflow.schema import SALES_PARTITION_COLUMNS


def aggregate_sales(raw: DataFrame) -> DataFrame:
    """P1, P3, F1, F3-F5, G2 (lazy)."""
    return sales_aggregate(with_date_parts(raw))


def run_aggregate_job(raw: DataFrame, table: str, overwrite: str = "table", writers: int | None = None) -> str:
    """L2 + K2: write the aggregate into ``table``, partitioned by category, year, month.

    ``overwrite="table"`` replaces the whole table; ``"partitions"`` replaces only the
    (category, year, month) partitions present in this run and keeps the others (K5; the
    first run creates the table). Read back, the partition columns come last:
    total_amount, total_sales, avg_amount, category, year, month. The aggregate has one row
    per partition value, so the rows are spread over writer tasks and the one-file
    directories are written in parallel: ``writers`` of them, by default the session's shuffle width."""
    if overwrite not in ("table", "partitions"):
        raise ValueError(f"overwrite must be 'table' or 'partitions', got {overwrite!r}")
    agg = aggregate_sales(raw)
    if overwrite == "partitions" and raw.sparkSession.catalog.tableExists(table):
        overwrite_partitions(agg, table, distribute_by="spread", writers=writers)
    else:
        save_table(agg, table, partition_by=SALES_PARTITION_COLUMNS, distribute_by="spread", writers=writers)
    return table
