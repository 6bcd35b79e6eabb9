"""Write docs/PLANS.md: the physical plans of the main jobs over the sf0.01 tables.

    python tests/scripts/dump_plans.py [sf_dir]
"""

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

from salesflow.operators import (  # noqa: E402
    category_summary,
    clean_sales,
    distribute,
    monthly_totals,
    partition_files,
    table_location,
    with_partition_values,
)
from salesflow.plans import aggregate_sales, load_partitioned, stage_sales, verify_load  # noqa: E402
from salesflow.schema import SALES_PARTITION_COLUMNS  # noqa: E402
from salesflow.session import build_session, scratch_database, scratch_location  # noqa: E402
from salesflow.sources import ADAPTER_ID_TYPE, read_partitioned, sales_from_tpch  # noqa: E402


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    text = re.sub(r"file:/\S+?(salesflow[^,\]\s]*)", r".../\1", out.getvalue())
    return re.sub(r"#\d+L?", "", text).strip()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    sales = sales_from_tpch(spark, sf_dir)
    loaded = load_partitioned(
        spark, scratch_database(spark), stage_sales(sales, scratch_location(spark, "st"), ADAPTER_ID_TYPE),
        id_type=ADAPTER_ID_TYPE,
    )
    root = table_location(spark, loaded.partitioned_table)
    staged = spark.table(loaded.staging_table)
    sections = [
        ("Flagship: ETL transform + category summary (G3), `entry()`", category_summary(clean_sales(sales))),
        ("Partitioned load (L1): rows as they reach the writers (`rebalance`)",
         distribute(with_partition_values(staged), SALES_PARTITION_COLUMNS, "rebalance")),
        ("Aggregate job (L2): aggregate as it reaches the writers (`spread`)",
         distribute(aggregate_sales(sales), SALES_PARTITION_COLUMNS, "spread")),
        ("ETL (L3): per-(year, month, category) totals for both summaries",
         monthly_totals(clean_sales(read_partitioned(spark, root, id_type=ADAPTER_ID_TYPE)))),
        ("Load verification (G1 + O2) on the catalog table", verify_load(spark, loaded.partitioned_table)),
        ("Partition file listing (C6)", partition_files(spark.table(loaded.partitioned_table))),
    ]
    # A load where one partition value holds 40% of the rows, run, then shown as AQE finished
    # it. The advisory size is lowered so that test-sized data counts as skewed.
    from tests.test_skew import _skewed_sales

    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    hot = distribute(with_partition_values(_skewed_sales(spark)), SALES_PARTITION_COLUMNS, "rebalance")
    hot.collect()
    hot_plan = plan(hot).split("+- == Initial Plan ==")[0].rstrip()
    lines = [
        "# Physical plans",
        "",
        f"Generated by `tests/scripts/dump_plans.py` over `{sf_dir}` (`local[8]`, 8 shuffle partitions, AQE on).",
        "All but the last plan are shown before execution (AQE may still coalesce or split shuffle",
        "partitions, and at this size `part` is small enough for Spark's broadcast size check); the",
        "last one is shown as AQE finished it. Expression ids and scratch paths are shortened.",
        "",
    ]
    for title, df in sections:
        lines += [f"## {title}", "", "```", plan(df), "```", ""]
    lines += [
        "## Load with one partition value holding 40% of the rows, after execution",
        "",
        "AQE split the hot value's shuffle partition (`AQEShuffleRead skewed`), so several writer tasks",
        "share it. Advisory partition size lowered to 256 KB so that test-sized data counts as skewed",
        "(`tests/test_skew.py` checks the files and rows).",
        "",
        "```",
        hot_plan,
        "```",
        "",
    ]
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
