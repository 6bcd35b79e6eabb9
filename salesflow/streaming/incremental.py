"""The partitioned load (L1) over staging files as they arrive.

A file-source stream over the staging folder feeds the Parquet file sink, partitioned
by ``category, year, month``. The sink's metadata log commits each micro-batch once,
so a restarted or retried run neither loses nor repeats rows; the checkpoint records
which staging files are done. Readers must read the output root as one path (not a
glob), so only committed files are seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from salesflow.operators import with_partition_values
from salesflow.schema import SALES_PARTITION_COLUMNS, raw_sales_schema, sales_file_schema

#: Staging files of one micro-batch.
FILES_PER_BATCH = 64
#: Writers of one partition value in a micro-batch, and so its files there: a value that holds a third of a batch is written
#: in pieces of a twelfth, while the number of files does not grow with the shuffle width.
WRITERS_PER_VALUE = 4


def start_incremental_load(
    spark: SparkSession,
    staging_dir: str,
    output_root: str,
    checkpoint_location: str,
    id_type: str = "int",
    files_per_batch: int = FILES_PER_BATCH,
    writers_per_value: int = WRITERS_PER_VALUE,
) -> StreamingQuery:
    """Load every staging file not yet loaded, then stop (``availableNow``).

    Skew is handled here, since not every version re-plans micro-batches: rows go to writers by
    partition value plus a salt of ``writers_per_value`` buckets; raise it for large batches of
    few values. The salt is a hash of the row's file and place in it, so equal rows spread, and a retried task sends every row to
    the same writer. ``files_per_batch`` bounds the size of each micro-batch."""
    reader = spark.readStream.schema(raw_sales_schema(id_type)).option("maxFilesPerTrigger", files_per_batch)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    staged = reader.parquet(staging_dir).withColumn("_salt", F.pmod(place, F.lit(writers_per_value)))
    rows = with_partition_values(staged, "_salt")
    return (
        rows.repartition(width, *SALES_PARTITION_COLUMNS, "_salt")
        .drop("_salt")
        .writeStream.format("parquet")
        .partitionBy(*SALES_PARTITION_COLUMNS)
        .option("path", output_root)
        .option("checkpointLocation", checkpoint_location)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def run_incremental_load(
    spark: SparkSession,
    staging_dir: str,
    output_root: str,
    checkpoint_location: str,
    id_type: str = "int",
    files_per_batch: int = FILES_PER_BATCH,
    writers_per_value: int = WRITERS_PER_VALUE,
) -> None:
    """Start the load and wait until the files present at the start are loaded."""
    query = start_incremental_load(
        spark, staging_dir, output_root, checkpoint_location, id_type, files_per_batch, writers_per_value
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def read_incremental_output(spark: SparkSession, output_root: str, id_type: str = "int") -> DataFrame:
    """The committed rows, with STRING partition columns as loaded ('01' stays '01')."""
    partitions = [StructField(c, StringType(), True) for c in SALES_PARTITION_COLUMNS]
    schema = StructType(sales_file_schema(id_type).fields + partitions)
    return spark.read.schema(schema).parquet(output_root)
