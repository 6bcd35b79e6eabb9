"""Run in its own JVM with task retries on: a writer task fails after writing rows, is retried,
and the table still holds every row exactly once. Prints one JSON line."""

import json
import sys

sys.path.insert(0, sys.argv[1])

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from salesflow.operators import (  # noqa: E402
    create_partitioned_sales_table,
    insert_into,
    partition_revenue,
    rebalance,
    with_partition_values,
)
from salesflow.schema import SALES_PARTITION_COLUMNS  # noqa: E402
from salesflow.session import scratch_database  # noqa: E402

spark = (
    SparkSession.builder.master("local[4,4]")
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")

n = 40_000
rows = spark.range(n).select(
    F.col("id").cast("int").alias("id"),
    F.format_string("2024-%02d-15", F.col("id") % 12 + 1).alias("sale_date"),
    F.lit("item").alias("product"),
    (F.col("id") % 100 + 0.5).alias("amount"),
    F.concat(F.lit("c"), (F.col("id") % 5).cast("string")).alias("category"),
)
staged = with_partition_values(rows)


def fail_first_attempt(batches):
    ctx = TaskContext.get()
    for i, pdf in enumerate(batches):
        if i == 1 and ctx.attemptNumber() == 0 and ctx.partitionId() == 0:
            raise RuntimeError("injected failure after the first batch was written")
        yield pdf


flaky = rebalance(staged, SALES_PARTITION_COLUMNS).mapInPandas(fail_first_attempt, staged.schema)
table = create_partitioned_sales_table(spark, f"{scratch_database(spark)}.retry")
insert_into(flaky, table, distribute_by="none")

got = {tuple(r[:3]): r.cnt for r in partition_revenue(spark.table(table)).collect()}
want = {tuple(r[:3]): r.cnt for r in partition_revenue(staged).collect()}
ids = spark.table(table).agg(F.count("*").alias("n"), F.countDistinct("id").alias("d")).first()
tracker = spark.sparkContext.statusTracker()
failed = 0
for job_id in tracker.getJobIdsForGroup(None):
    job = tracker.getJobInfo(job_id)
    for stage_id in job.stageIds if job else []:
        stage = tracker.getStageInfo(stage_id)
        failed += stage.numFailedTasks if stage else 0
print(json.dumps({
    "rows": ids.n, "distinct_ids": ids.d, "expected": n, "per_partition_equal": got == want, "failed_tasks": failed,
}))
