"""Run in its own JVM with Hive support (working folder: a scratch folder for the metastore):
load into a Hive-format table as the reference defines it, then overwrite one category.
Prints one JSON line."""

import json
import sys

sys.path.insert(0, sys.argv[1])

from pyspark.sql import SparkSession  # noqa: E402

from salesflow.operators import insert_into, list_partitions, overwrite_partitions, with_partition_values  # noqa: E402
from salesflow.sources import sales_from_rows  # noqa: E402
from tests.conftest import FIXTURE_A  # noqa: E402

spark = (
    SparkSession.builder.master("local[2]")
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .enableHiveSupport()
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
spark.sql("CREATE DATABASE IF NOT EXISTS sales_hive")
spark.sql(
    "CREATE TABLE IF NOT EXISTS sales_hive.sales_partitioned (id INT, sale_date STRING, product STRING, amount DOUBLE) "
    "PARTITIONED BY (category STRING, year STRING, month STRING) STORED AS PARQUET"
)
rows = with_partition_values(sales_from_rows(spark, FIXTURE_A))
insert_into(rows, "sales_hive.sales_partitioned")
first = spark.table("sales_hive.sales_partitioned").count()
overwrite_partitions(rows.where("id = 3"), "sales_hive.sales_partitioned")
after = sorted((r.category, r.month) for r in spark.table("sales_hive.sales_partitioned").collect())
parts = sorted(r[0] for r in list_partitions(spark, "sales_hive.sales_partitioned").collect())
provider = [r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED sales_hive.sales_partitioned").collect() if r.col_name == "Provider"]
print(json.dumps({
    "catalog": spark.conf.get("spark.sql.catalogImplementation"), "provider": provider,
    "first": first, "after": after, "partitions": parts,
}))
