"""Group-by aggregates.

All are hash aggregates with a partial (map-side) step, so a key holding a third of all
rows leaves each task as one partial row and never lands whole in one task.
``sum``/``avg``/``min``/``max`` skip NULL amounts; a NULL key forms its own group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.functions import round_money
from salesflow.schema import SALES_PARTITION_COLUMNS

MONTHLY_KEYS = ("year", "month", "category")


def partition_revenue(df: DataFrame, keys: tuple[str, ...] = SALES_PARTITION_COLUMNS) -> DataFrame:
    """G1: rows and revenue per partition: ``cnt = count(*)``, ``revenue = sum(amount)``."""
    return df.groupBy(*keys).agg(F.count("*").alias("cnt"), F.sum("amount").alias("revenue"))


def sales_aggregate(df: DataFrame) -> DataFrame:
    """Per (category, year, month): ``total_amount``, ``total_sales = count(id)``
    (NULL ids are not counted), ``avg_amount``."""
    return df.groupBy(*SALES_PARTITION_COLUMNS).agg(
        F.sum("amount").alias("total_amount"),
        F.count("id").alias("total_sales"),
        F.avg("amount").alias("avg_amount"),
    )


def category_summary(df: DataFrame) -> DataFrame:
    """Per category: count, rounded revenue and mean, min and max amount."""
    return df.groupBy("category").agg(
        F.count("*").alias("total_sales"),
        round_money(F.sum("amount")).alias("total_revenue"),
        round_money(F.avg("amount")).alias("avg_amount"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
    )


def monthly_summary(df: DataFrame) -> DataFrame:
    """Per (year, month, category): count, rounded revenue and mean."""
    return df.groupBy(*MONTHLY_KEYS).agg(
        F.count("*").alias("total_sales"),
        round_money(F.sum("amount")).alias("total_revenue"),
        round_money(F.avg("amount")).alias("avg_amount"),
    )


def row_count(df: DataFrame) -> DataFrame:
    """The number of rows, as a one-row DataFrame (``row_count``)."""
    return df.agg(F.count("*").alias("row_count"))


def monthly_totals(df: DataFrame) -> DataFrame:
    """Unrounded per-(year, month, category) totals from which both G3 and G4 follow.

    One scan of the sales rows feeds both summaries; the result has one row per group,
    so it is small whatever the row count."""
    return df.groupBy(*MONTHLY_KEYS).agg(
        F.count("*").alias("n_rows"),
        F.count("amount").alias("n_amounts"),
        F.sum("amount").alias("amount_sum"),
        F.min("amount").alias("amount_min"),
        F.max("amount").alias("amount_max"),
    )


def monthly_summary_from_totals(totals: DataFrame) -> DataFrame:
    """G4 from ``monthly_totals``: the same groups, so the same values."""
    return totals.select(
        *MONTHLY_KEYS,
        F.col("n_rows").alias("total_sales"),
        round_money(F.col("amount_sum")).alias("total_revenue"),
        round_money(F.try_divide(F.col("amount_sum"), F.col("n_amounts"))).alias("avg_amount"),
    )


def category_summary_from_totals(totals: DataFrame) -> DataFrame:
    """G3 rolled up from ``monthly_totals``: counts, sums, min and max combine exactly;
    the mean is the rolled-up sum over the rolled-up count of non-NULL amounts."""
    amount_sum = F.sum("amount_sum")
    return totals.groupBy("category").agg(
        F.sum("n_rows").alias("total_sales"),
        round_money(amount_sum).alias("total_revenue"),
        round_money(F.try_divide(amount_sum, F.sum("n_amounts"))).alias("avg_amount"),
        F.min("amount_min").alias("min_amount"),
        F.max("amount_max").alias("max_amount"),
    )
