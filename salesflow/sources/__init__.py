"""Sources: typed rows, staging files, partitioned paths, catalog tables, test-table adapter."""

from salesflow.sources.files import PARTITION_PATTERN, conform, read_partitioned, write_staging_file
from salesflow.sources.rows import sales_from_rows
from salesflow.sources.tables import check_columns, create_external_table, read_table
from salesflow.sources.tpch import ADAPTER_ID_TYPE, sales_from_tpch, table_path

__all__ = [
    "ADAPTER_ID_TYPE",
    "PARTITION_PATTERN",
    "check_columns",
    "conform",
    "create_external_table",
    "read_partitioned",
    "read_table",
    "sales_from_rows",
    "sales_from_tpch",
    "table_path",
    "write_staging_file",
]
