"""salesflow: batch sales ETL and analytics on Spark DataFrames and Spark SQL.

Layout: ``sources`` (reads), ``functions`` (column expressions), ``operators``
(transforms, aggregates, catalog, sinks, inspection), ``plans`` (end-to-end jobs),
``streaming`` (incremental form of the partitioned load). The jobs are re-exported here.
"""

from salesflow.plans import (
    inspect_table,
    load_partitioned,
    run_aggregate_job,
    run_etl,
    stage_sales,
    verify_load,
)
from salesflow.streaming import run_incremental_load

__version__ = "0.1.0"

__all__ = [
    "inspect_table",
    "load_partitioned",
    "run_aggregate_job",
    "run_etl",
    "run_incremental_load",
    "stage_sales",
    "verify_load",
]
