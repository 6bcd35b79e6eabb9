"""L3 published as one: three tables of a new generation, and one step that makes them the ones to read."""

from __future__ import annotations

from pyspark.sql import SparkSession

from salesflow.operators import StepCounts, create_database, generation_table, next_generation, published_generation
from salesflow.plans.etl import ETL_TABLE_NAMES, EtlTables, run_etl
from salesflow.schema import MID_FROM, PREMIUM_FROM

NAME = "etl"


def publish_etl(
    spark: SparkSession,
    source_root: str,
    database: str,
    id_type: str = "int",
    premium_from: float = PREMIUM_FROM,
    mid_from: float = MID_FROM,
    keep: int = 1,
    counts: StepCounts | None = None,
) -> EtlTables:
    """Run the ETL into a new generation and publish its three tables together. A run that fails, at whatever step, leaves
    ``published_tables`` as it was."""
    create_database(spark, database)
    with next_generation(spark, database, NAME, ETL_TABLE_NAMES, keep) as made:
        tables = EtlTables(database, *(made.table(base) for base in ETL_TABLE_NAMES))
        run_etl(spark, source_root, database, id_type, premium_from, mid_from, tables=tables, counts=counts)
    return tables


def published_tables(spark: SparkSession, database: str) -> EtlTables:
    """The three tables that belong together now. Raises LookupError before the first publication."""
    label = published_generation(spark, database, NAME)
    if label is None:
        raise LookupError(f"nothing is published in {database}")
    return EtlTables(database, *(generation_table(database, base, label) for base in ETL_TABLE_NAMES))
