"""Declared schemas and fixed values of the sales data model.

Every schema is declared, never inferred.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# These must equal the reference for equal results.
# Price bands, first match wins: amount >= 1000 is premium, >= 300 is mid, else budget.
PREMIUM_FROM = 1000.0
MID_FROM = 300.0
BAND_PREMIUM = "premium"
BAND_MID = "mid"
BAND_BUDGET = "budget"
# Date text layout of sale_date, and the layout of partitioned tables.
DATE_FORMAT = "yyyy-MM-dd"
SALES_PARTITION_COLUMNS = ("category", "year", "month")
TRANSFORMED_PARTITION_COLUMNS = ("category", "price_category")
MONTHLY_PARTITION_COLUMNS = ("year", "month")
# Measures of the verification, the aggregate job and the ETL's summaries: their output column names.
REVENUE_COLUMNS = ("category", "year", "month", "cnt", "revenue")
AGGREGATE_COLUMNS = ("total_amount", "total_sales", "avg_amount")
SUMMARY_COLUMNS = ("total_sales", "total_revenue", "avg_amount", "min_amount", "max_amount")

ID_TYPES: dict[str, DataType] = {"int": IntegerType(), "bigint": LongType()}


def _id_type(id_type: str) -> DataType:
    try:
        return ID_TYPES[id_type]
    except KeyError:
        raise ValueError(f"id_type must be one of {sorted(ID_TYPES)}, got {id_type!r}") from None


def sales_file_schema(id_type: str = "int") -> StructType:
    """The four data columns stored in each partition file (names and types are fixed values too)."""
    return StructType(
        [
            StructField("id", _id_type(id_type), True),
            StructField("sale_date", StringType(), True),
            StructField("product", StringType(), True),
            StructField("amount", DoubleType(), True),
        ]
    )


def raw_sales_schema(id_type: str = "int") -> StructType:
    """Raw / staging sales rows: the file columns plus ``category``."""
    return StructType(sales_file_schema(id_type).fields + [StructField("category", StringType(), True)])


def partitioned_sales_schema(id_type: str = "int") -> StructType:
    """Columns of the partitioned table: the file columns, then STRING partition columns."""
    parts = [StructField(c, StringType(), True) for c in SALES_PARTITION_COLUMNS]
    return StructType(sales_file_schema(id_type).fields + parts)


def raw_sales_ddl(id_type: str = "int") -> str:
    """Column list of the staging table, as SQL DDL."""
    return ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in raw_sales_schema(id_type).fields)


def partitioned_sales_ddl(id_type: str = "int") -> str:
    """Column list of the partitioned table: data columns, then STRING partition columns."""
    data = ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in sales_file_schema(id_type).fields)
    parts = ", ".join(f"{c} STRING" for c in SALES_PARTITION_COLUMNS)
    return f"{data}, {parts}"
