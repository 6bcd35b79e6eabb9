"""Session settings and shared scratch locations.

On a cluster the shared folder is the one named by ``spark.checkpoint.dir``;
it is read from the session and only set here when it is unset (tests).
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from salesflow.functions.names import quoted_text

# Settings the library relies on. AQE re-plans at runtime: it coalesces small
# shuffle partitions, splits skewed join partitions (a hot key can hold a third
# of the rows) and splits skewed partitions behind the write-side REBALANCE.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "salesflow") -> SparkSession:
    """Session for tests and the bench; a cluster job gets its session from the launcher."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        # Listing many partition folders runs as a Spark job with one task per folder up to
        # this cap; size it to the cores at hand (a cluster sizes it to its executors).
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(4 * shuffle_partitions))
        # AQE keeps coalesced shuffle partitions at this size or more; with the 1 MB default a
        # small load into hundreds of partition folders gets one to three writer tasks. The
        # floor only matters when the shuffle is smaller than cores x 1 MB.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
    )
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def _own_folder(spark: SparkSession) -> str:
    """A folder in the warehouse, which all executors share, for sessions that configure none."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_salesflow"


def shared_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set only when unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, the setting is all there is
        configured = spark.conf.get("spark.checkpoint.dir", None)
        return (configured or _own_folder(spark)).rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc.setCheckpointDir(configured or _own_folder(spark))
    return sc.getCheckpointDir().rstrip("/")


def scratch_location(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root."""
    return f"{shared_root(spark)}/salesflow/{name}-{uuid.uuid4().hex[:12]}"


def scratch_database(spark: SparkSession, prefix: str = "salesflow") -> str:
    """Create a uniquely named database whose managed tables live under the shared root."""
    name = f"{prefix}_{uuid.uuid4().hex[:12]}"
    location = f"{shared_root(spark)}/salesflow/warehouse/{name}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION {quoted_text(location)}")
    return name
