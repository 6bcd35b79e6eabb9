"""The load with its bad rows kept (F1/F2): one pass over the staging rows writes the good ones and the rejected ones,
these with a reason, where the plain load gives a NULL date and a NULL partition."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.functions import parse_date, parse_sale_date
from salesflow.functions.names import quoted_text
from salesflow.operators import create_database, distribute, with_partition_values
from salesflow.schema import DATE_FORMAT, SALES_PARTITION_COLUMNS, partitioned_sales_ddl, raw_sales_schema

GOOD, REJECTED = "good", "rejected"
NO_DATE, BAD_DATE, ODD_DATE = "no date", "not a date", f"date not as {DATE_FORMAT}"


@dataclass(frozen=True)
class CheckedTables:
    good: str
    rejected: str


def reject_reason(sale_date: Column | str = "sale_date") -> Column:
    """Why a row's date can't be used; NULL where it can. A date that only the cast rules read ('2024-1-5') is odd: the
    load would file it, and the ETL would lose it."""
    c = F.col(sale_date) if isinstance(sale_date, str) else sale_date
    odd = F.when(parse_date(c).isNull(), BAD_DATE).otherwise(ODD_DATE)
    return F.when(c.isNull(), NO_DATE).when(parse_sale_date(c).isNull(), odd)


def load_checked(
    spark: SparkSession, database: str, staging_location: str, root: str, id_type: str = "int", name: str = "sales_checked"
) -> CheckedTables:
    """Write the staging rows below ``root`` in one job, ``outcome=good`` and ``outcome=rejected``, and make a table of
    each: the good rows with the columns of the partitioned table, the rejected ones with ``reason`` too. Both are
    partitioned by category, year and month; of a rejected row year and month are those of its date where it has one.
    What was below ``root`` is replaced."""
    create_database(spark, database)
    staged = spark.read.schema(raw_sales_schema(id_type)).parquet(staging_location)
    rows = with_partition_values(staged.withColumn("reason", reject_reason()), "reason")
    rows = rows.withColumn("outcome", F.when(F.col("reason").isNull(), GOOD).otherwise(REJECTED))
    parts = ["outcome", *SALES_PARTITION_COLUMNS]
    distribute(rows, parts, "rebalance").write.mode("overwrite").partitionBy(*parts).parquet(root)
    tables = CheckedTables(f"{database}.{name}", f"{database}.{name}_rejected")
    data = partitioned_sales_ddl(id_type).split(", ")
    own = len(data) - len(SALES_PARTITION_COLUMNS)
    for table, outcome, more in ((tables.good, GOOD, []), (tables.rejected, REJECTED, ["reason STRING"])):
        folder = f"{root.rstrip('/')}/outcome={outcome}"
        rows.drop("outcome", *SALES_PARTITION_COLUMNS).limit(0).write.mode("append").parquet(folder)  # there even if empty
        columns = ", ".join([*data[:own], *more, *data[own:]])
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING PARQUET PARTITIONED BY ({', '.join(SALES_PARTITION_COLUMNS)}) "
            f"LOCATION {quoted_text(folder)}"
        )
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return tables


def reject_summary(spark: SparkSession, tables: CheckedTables) -> DataFrame:
    """``reason, rows`` of the rejected rows."""
    return spark.table(tables.rejected).groupBy("reason").agg(F.count("*").alias("rows"))
