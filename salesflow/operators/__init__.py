"""DataFrame operators: transforms, aggregates, ordering, catalog, sinks, inspection."""

from salesflow.operators.aggregates import (
    category_summary,
    category_summary_from_totals,
    monthly_summary,
    monthly_summary_from_totals,
    monthly_totals,
    partition_revenue,
    row_count,
    sales_aggregate,
)
from salesflow.operators.catalog import (
    create_database,
    create_partitioned_sales_table,
    list_partitions,
    drop_partitions,
    list_tables,
    partition_columns,
    partition_values,
    file_listing,
    partition_files,
    table_location,
    use_database,
    using_database,
)
from salesflow.operators.counts import StepCounts
from salesflow.operators.exact_sums import exact_mean, exact_sum, exact_totals, merged_totals
from salesflow.operators.generations import generation_table, next_generation, published_generation
from salesflow.operators.inspect import (
    column_names,
    describe_table,
    partition_balance,
    partition_count,
    schema_text,
    whole_partition_balance,
)
from salesflow.operators.keys import with_keys_of, without_keys_of
from salesflow.operators.ordering import first_rows, sort_rows
from salesflow.operators.sinks import (
    compact_table,
    distribute,
    file_bins,
    insert_into,
    overwrite_partitions,
    overwrite_path_partitions,
    rebalance,
    save_sorted,
    save_table,
    spread,
)
from salesflow.operators.transforms import clean_sales, with_date_parts, with_partition_values

__all__ = [
    "compact_table",
    "file_bins",
    "save_sorted",
    "drop_partitions",
    "partition_values",
    "StepCounts",
    "exact_mean",
    "exact_sum",
    "exact_totals",
    "merged_totals",
    "generation_table",
    "next_generation",
    "published_generation",
    "partition_count",
    "whole_partition_balance",
    "with_keys_of",
    "without_keys_of",
    "category_summary",
    "category_summary_from_totals",
    "clean_sales",
    "column_names",
    "create_database",
    "create_partitioned_sales_table",
    "describe_table",
    "distribute",
    "first_rows",
    "insert_into",
    "list_partitions",
    "list_tables",
    "monthly_summary",
    "monthly_summary_from_totals",
    "monthly_totals",
    "overwrite_partitions",
    "overwrite_path_partitions",
    "partition_balance",
    "partition_columns",
    "file_listing",
    "partition_files",
    "partition_revenue",
    "rebalance",
    "row_count",
    "sales_aggregate",
    "save_table",
    "schema_text",
    "sort_rows",
    "spread",
    "table_location",
    "use_database",
    "using_database",
    "with_date_parts",
    "with_partition_values",
]
