"""Table inspection (I1-I4). Counts and samples run as Spark jobs; names and types come
from the plan's schema, without reading rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def column_names(df: DataFrame) -> list[str]:
    """Column names, from the schema."""
    return df.columns


def schema_text(df: DataFrame) -> str:
    """I2 as ``printSchema`` prints it (a tree of names, types, nullability), from the schema."""
    return df.schema.treeString()


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    """``col_name, data_type, comment`` per column, then the partition columns again
    under '# Partition Information' (``DESCRIBE TABLE``)."""
    return spark.sql(f"DESCRIBE TABLE {table}")


def partition_balance(df: DataFrame) -> DataFrame:
    """I4: rows per Spark partition of ``df`` (``partition_id, rows``); empty partitions do not show."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count("*").alias("rows"))


def partition_count(df: DataFrame) -> int:
    """I4: the number of partitions that ``df`` is planned to have, empty ones included, from its query execution. The
    last stage does not run; with adaptive planning the shuffles before it do, since they decide the number."""
    return df._jdf.queryExecution().toRdd().getNumPartitions()


def whole_partition_balance(df: DataFrame) -> DataFrame:
    """I4: rows of every partition that ``df`` is planned to have; 0 for the empty ones. It
    holds for frames whose number of partitions is fixed (a scan, a repartition by number): a shuffle that adaptive
    planning may merge can come out otherwise in the count's own plan."""
    count = partition_count(df)
    every = df.sparkSession.range(count).select(F.col("id").cast("int").alias("partition_id"))
    filled = partition_balance(df)
    return every.join(filled, "partition_id", "left").select("partition_id", F.coalesce("rows", F.lit(0)).alias("rows"))
