"""Typed in-memory rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from salesflow.schema import raw_sales_schema


def sales_from_rows(spark: SparkSession, rows: Iterable[tuple], id_type: str = "int") -> DataFrame:
    """Rows of (id, sale_date, product, amount, category) with the declared raw schema.
    Meant for small literal inputs (fixtures, tests); large data comes from files or tables."""
    return spark.createDataFrame(list(rows), raw_sales_schema(id_type))
