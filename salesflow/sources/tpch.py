"""Adapter from the TPC-H style test tables to the ``sales`` shape.

Not an operator of the reference: it supplies ``sales`` rows at any scale.
``lineitem`` joins ``part`` on the part key:

    id = l_orderkey, sale_date = l_shipdate as 'yyyy-MM-dd', product = p_name,
    amount = l_extendedprice, category = p_type

``id`` stays BIGINT: order keys outgrow INT at large scale factors, and an ANSI
cast to INT would then fail the job. The ship date is taken as a date first, so the
text does not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.schema import DATE_FORMAT

ADAPTER_ID_TYPE = "bigint"


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def sales_from_tpch(spark: SparkSession, sf_dir: str, first_day: str | None = None) -> DataFrame:
    """Sales rows from ``lineitem`` and ``part``, from ``first_day`` on if it is given: the bound is on the
    ship date itself, so it reaches the scan, as one on the formatted text would not.

    The join is left to the planner: ``part`` is broadcast only when its measured size is
    under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks it at runtime), otherwise
    both sides shuffle on the part key and AQE splits a hot key's partition."""
    lineitem = spark.read.parquet(table_path(sf_dir, "lineitem")).select(
        "l_orderkey", "l_partkey", "l_extendedprice", "l_shipdate"
    )
    if first_day:
        lineitem = lineitem.where(F.col("l_shipdate") >= F.lit(first_day).cast(lineitem.schema["l_shipdate"].dataType))
    part = spark.read.parquet(table_path(sf_dir, "part")).select("p_partkey", "p_name", "p_type")
    return lineitem.join(part, lineitem.l_partkey == part.p_partkey, "inner").select(
        F.col("l_orderkey").alias("id"),
        F.date_format(F.to_date("l_shipdate"), DATE_FORMAT).alias("sale_date"),
        F.col("p_name").alias("product"),
        F.col("l_extendedprice").alias("amount"),
        F.col("p_type").alias("category"),
    )
