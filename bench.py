"""Time the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each timed step runs whole: reads use the ``noop`` sink (full execution, no
transfer of rows to the driver) or collect a small result; writes commit tables.
All jobs run once on the smallest tables first (JVM warm-up, reported, not counted);
then every job runs BENCH_REPEATS times (default 3) and its median time is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from salesflow.operators import (  # noqa: E402
    category_summary,
    clean_sales,
    overwrite_partitions,
    sort_rows,
    table_location,
    with_partition_values,
)
from salesflow.plans import (  # noqa: E402
    inspect_table,
    load_partitioned,
    monthly_report,
    run_aggregate_job,
    run_etl,
    stage_sales,
    verify_load,
)
from salesflow.queries import TEST_MID_FROM, TEST_PREMIUM_FROM  # noqa: E402
from salesflow.session import build_session, scratch_database, scratch_location  # noqa: E402
from salesflow.sources import ADAPTER_ID_TYPE, read_partitioned, sales_from_tpch  # noqa: E402
from salesflow.streaming import run_incremental_load  # noqa: E402


def warmup_dir(sf_dir: str) -> str:
    """The smallest tables next to the bench tables, or the bench tables themselves."""
    sibling = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    return sibling if os.path.exists(os.path.join(sibling, "lineitem.parquet")) else sf_dir


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def run_jobs(spark, sf_dir: str) -> dict[str, float]:
    """Run every job once over ``sf_dir``; seconds per job."""
    times: dict[str, float] = {}
    state: dict = {}

    def timed(name, fn):
        t = time.time()
        state[name] = fn()
        times[name] = round(time.time() - t, 3)

    sales = sales_from_tpch(spark, sf_dir)
    timed("clean_scan", lambda: _noop(clean_sales(sales, TEST_PREMIUM_FROM, TEST_MID_FROM)))
    timed("category_summary", lambda: sort_rows(category_summary(clean_sales(sales)), "category").collect())
    timed("stage", lambda: stage_sales(sales, scratch_location(spark, "staging"), ADAPTER_ID_TYPE))
    timed(
        "partitioned_load",
        lambda: load_partitioned(spark, scratch_database(spark), state["stage"], id_type=ADAPTER_ID_TYPE),
    )
    loaded = state["partitioned_load"]
    timed("load_verify", lambda: verify_load(spark, loaded.partitioned_table).collect())
    root = table_location(spark, loaded.partitioned_table)
    timed("partition_scan", lambda: _noop(read_partitioned(spark, root, id_type=ADAPTER_ID_TYPE)))
    timed("aggregate_job", lambda: run_aggregate_job(sales, f"{loaded.database}.sales_aggregated"))
    timed(
        "etl",
        lambda: run_etl(
            spark,
            root,
            loaded.database,
            id_type=ADAPTER_ID_TYPE,
            premium_from=TEST_PREMIUM_FROM,
            mid_from=TEST_MID_FROM,
        ),
    )
    timed("monthly_report", lambda: monthly_report(spark, state["etl"]).collect())

    def inspection():
        report = inspect_table(spark, loaded.partitioned_table)
        report.row_count.collect()
        report.schema.collect()
        report.partitions.collect()
        report.balance.collect()
        report.sample.collect()
        return report

    timed("inspection", inspection)

    # K5: replace the partitions from 1999 on with re-derived rows; the earlier ones stay.
    later = with_partition_values(sales_from_tpch(spark, sf_dir, "1999-01-01"))
    timed("partition_overwrite", lambda: overwrite_partitions(later, loaded.partitioned_table))
    # The load as a stream over the staging files (one micro-batch per file).
    timed(
        "stream_load",
        lambda: run_incremental_load(
            spark,
            state["stage"],
            scratch_location(spark, "stream-out"),
            scratch_location(spark, "stream-ckpt"),
            id_type=ADAPTER_ID_TYPE,
            files_per_batch=1,
        ),
    )
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    width = int(cpus) if cpus.isdigit() else 8
    spark = build_session(f"local[{cpus}]", shuffle_partitions=width, app="salesflow-bench")

    # Warm-up: every job once on the smallest tables (JIT, class loading), not counted.
    t0 = time.time()
    run_jobs(spark, warmup_dir(sf_dir))
    warmup = time.time() - t0

    # Each job's median over BENCH_REPEATS timed passes (the machine may be shared).
    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "3")))
    passes = [run_jobs(spark, sf_dir) for _ in range(repeats)]
    times = {job: round(statistics.median(p[job] for p in passes), 3) for job in passes[0]}

    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_sec",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "warmup_sec": round(warmup, 3),
                "repeats": repeats,
                "spread": {job: [min(p[job] for p in passes), max(p[job] for p in passes)] for job in times},
                "totals": [round(sum(p.values()), 3) for p in passes],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
