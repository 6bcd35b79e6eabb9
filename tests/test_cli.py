"""The command-line jobs, end to end."""

from salesflow.cli import main
from salesflow.operators import table_location
from salesflow.plans import stage_sales
from salesflow.session import scratch_location
from salesflow.sources import sales_from_rows


def test_cli_jobs(spark, fixture_a, capsys):
    staging = stage_sales(fixture_a, scratch_location(spark, "staging"))
    db = f"cli_{abs(hash(staging)) % 10**8}"
    loaded = main(["load", "--staging", staging, "--database", db])["tables"]
    assert spark.table(loaded.partitioned_table).count() == 6

    agg = main(["aggregate", "--staging", staging, "--table", f"{db}.sales_aggregated"])["table"]
    assert spark.table(agg).count() == 4

    etl = main(["etl", "--source", table_location(spark, loaded.partitioned_table), "--database", f"{db}_etl"])["tables"]
    assert [r.category for r in spark.table(etl.by_category).orderBy("category").collect()] == ["home goods", "sport"]

    root = table_location(spark, loaded.partitioned_table)
    found = main(["etl", "--source", root, "--database", f"{db}_found", "--wildcard"])["tables"]
    assert spark.table(found.transformed).count() == 6

    report = main(["inspect", "--table", loaded.partitioned_table])["report"]
    assert report.row_count.first().row_count == 6
    out = capsys.readouterr().out
    assert "category=home goods/year=2022/month=01" in out and "1259.88" in out


def test_load_keeps_more_than_it_shows(spark, capsys):
    rows = [(i, f"{2000 + i}-01-05", "kettle", 1.0 * i, "home goods") for i in range(25)]
    staging = stage_sales(sales_from_rows(spark, rows), scratch_location(spark, "staging"))
    db = f"cli_{abs(hash(staging)) % 10**8}"
    made = main(["--show", "7", "load", "--staging", staging, "--database", db])
    assert [spark.table(t).count() for t in made["reports"]] == [25, 25, 25]
    assert "load_partitions: 25 rows, the first 7 of them" in capsys.readouterr().out
    out = scratch_location(spark, "report")
    main(["inspect", "--table", made["tables"].partitioned_table, "--out", out])
    assert spark.read.parquet(f"{out}/partitions").count() == 25
