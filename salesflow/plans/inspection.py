"""L4: read a table and describe it: count, columns, schema, partitions, balance, sample."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from salesflow.operators import (
    column_names,
    describe_table,
    first_rows,
    list_partitions,
    partition_balance,
    partition_columns,
    row_count,
    schema_text,
)
from salesflow.sources import read_table


@dataclass(frozen=True)
class TableReport:
    table: str
    columns: list[str]
    schema_tree: str
    row_count: DataFrame
    schema: DataFrame
    partitions: DataFrame | None
    balance: DataFrame
    sample: DataFrame


def inspect_table(spark: SparkSession, table: str, sample_size: int = 3, ordered_sample: bool = False) -> TableReport:
    """S6, G5, I1-I4, O3. All parts are lazy DataFrames except the column names.

    The sample is unordered by default, like ``show(3)``: it reads only as many splits as
    it needs. An ordered sample is deterministic but scans every column of every row."""
    df = read_table(spark, table)
    partitioned = bool(partition_columns(spark, table))
    return TableReport(
        table=table,
        columns=column_names(df),
        schema_tree=schema_text(df),
        row_count=row_count(df),
        schema=describe_table(spark, table),
        partitions=list_partitions(spark, table) if partitioned else None,
        balance=partition_balance(df),
        sample=first_rows(df, sample_size, order_by=df.columns if ordered_sample else None),
    )
