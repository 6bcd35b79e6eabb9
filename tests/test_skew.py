"""A hot partition value (over a third of all rows) is split across writer tasks."""

from pyspark.sql import functions as F

from salesflow.operators import (
    create_partitioned_sales_table,
    insert_into,
    partition_files,
    partition_revenue,
    with_partition_values,
)
from salesflow.session import scratch_database


def _skewed_sales(spark, n=400_000):
    # 40% of the rows share one category and month; the rest spread over 40 categories.
    hot = F.col("id") % 5 < 2
    return spark.range(n).select(
        F.col("id").cast("int").alias("id"),
        F.when(hot, F.lit("2024-01-15")).otherwise(F.format_string("2024-%02d-01", F.col("id") % 12 + 1)).alias("sale_date"),
        F.concat(F.lit("item "), (F.col("id") % 97).cast("string")).alias("product"),
        (F.col("id") % 1000 + 0.5).alias("amount"),
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 40).cast("string"))).alias("category"),
    )


def test_hot_partition_is_split_and_complete(spark):
    confs = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    previous = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        table = create_partitioned_sales_table(spark, f"{scratch_database(spark)}.skewed")
        src = _skewed_sales(spark)
        insert_into(with_partition_values(src), table)
    finally:
        for k, v in previous.items():
            spark.conf.set(k, v)

    files = {(r.category, r.year, r.month): (r.files, r.rows) for r in partition_files(spark.table(table)).collect()}
    hot_files, hot_rows = files[("hot", "2024", "01")]
    assert hot_rows == 160_000
    assert hot_files > 1, "the hot partition value was written by a single task"
    # Whole result: every row arrived, per partition value.
    got = {(r.category, r.year, r.month): r.cnt for r in partition_revenue(spark.table(table)).collect()}
    want = {(r.category, r.year, r.month): r.cnt for r in partition_revenue(with_partition_values(src)).collect()}
    assert got == want
    assert sum(got.values()) == 400_000


def test_spread_keeps_small_aggregate_on_many_writers(spark):
    from salesflow.operators import sales_aggregate, spread, with_date_parts
    from salesflow.schema import SALES_PARTITION_COLUMNS

    agg = sales_aggregate(with_date_parts(with_partition_values(_skewed_sales(spark, 50_000)).drop("year", "month")))

    def writers(df):
        return df.select(F.spark_partition_id().alias("p")).distinct().count()

    # The planner drops a repartition on the aggregate's own keys and AQE merges the small
    # aggregate into one task; spreading by a hash of the values keeps the writers apart.
    assert writers(agg.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *SALES_PARTITION_COLUMNS)) == 1
    assert writers(spread(agg, SALES_PARTITION_COLUMNS)) > 1
    assert 1 < writers(spread(agg, SALES_PARTITION_COLUMNS, 3)) <= 3
    assert spread(agg, SALES_PARTITION_COLUMNS).count() == agg.count()


def test_hot_join_key_is_split_by_aqe(spark):
    """The adapter's join with 40% of lineitem on one part key: with broadcast off it is a
    sort-merge join, and AQE splits the hot key's partition (no row lost)."""
    import contextlib
    import datetime as dt
    import io

    from salesflow.session import scratch_location
    from salesflow.sources import sales_from_tpch

    root = scratch_location(spark, "skewed-tables")
    n = 200_000
    hot = F.col("id") % 5 < 2
    spark.range(n).select(
        F.col("id").alias("l_orderkey"),
        F.when(hot, F.lit(7)).otherwise(F.col("id") % 1000).alias("l_partkey"),
        (F.col("id") % 997 + 0.25).alias("l_extendedprice"),
        F.lit(dt.datetime(1996, 3, 4)).cast("timestamp_ntz").alias("l_shipdate"),
    ).repartition(8).write.parquet(f"{root}/lineitem.parquet")
    spark.range(1000).select(
        F.col("id").alias("p_partkey"),
        F.concat(F.lit("part "), F.col("id").cast("string")).alias("p_name"),
        F.lit("T").alias("p_type"),
    ).write.parquet(f"{root}/part.parquet")

    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    previous = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        df = sales_from_tpch(spark, root)
        per_key = df.groupBy("product").count()
        rows = {r["product"]: r["count"] for r in per_key.collect()}
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            per_key.explain()
        plan = out.getvalue()
    finally:
        for k, v in previous.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "isFinalPlan=true" in plan and "SortMergeJoin(skew=true)" in plan
    assert sum(rows.values()) == n
    assert rows["part 7"] == spark.read.parquet(f"{root}/lineitem.parquet").where("l_partkey = 7").count()
