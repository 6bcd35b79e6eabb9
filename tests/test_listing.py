"""Recursive listing, partition counts, exact sums, and the staging table's safety."""

import math
import os
import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesflow.operators import (
    create_database,
    exact_mean,
    exact_sum,
    exact_totals,
    merged_totals,
    partition_count,
    save_table,
    whole_partition_balance,
)
from salesflow.session import scratch_database, scratch_location
from salesflow.sources import create_external_table, sales_from_rows, write_staging_file
from salesflow.sources.listing import data_files, list_folder, listed_partitions, with_folder_values

ROWS = [(1, "2021-10-31", "wall clock", 1000.0, "home goods"), (2, "2022-01-09", "kettle", 0.1, None), (3, "2022-02-09", "cup", 0.2, "a/b +%é=x")]


# --- the staging table ---


@pytest.fixture
def staged(spark):
    return write_staging_file(sales_from_rows(spark, ROWS), scratch_location(spark, "staging's"))


def test_a_managed_table_is_never_pointed_elsewhere(spark, staged):
    table = f"{scratch_database(spark)}.sales_staging"
    save_table(sales_from_rows(spark, ROWS[:1]), table)
    with pytest.raises(ValueError, match="MANAGED"):
        create_external_table(spark, table, staged)
    assert spark.table(table).count() == 1
    spark.sql(f"DROP TABLE {table}")
    assert spark.read.parquet(staged).count() == 3


def test_a_view_under_the_name_is_refused(spark, staged):
    database = scratch_database(spark)
    spark.sql(f"CREATE VIEW {database}.sales_staging AS SELECT 1 AS id")
    with pytest.raises(ValueError, match="VIEW"):
        create_external_table(spark, f"{database}.sales_staging", staged)
    sales_from_rows(spark, ROWS).createOrReplaceTempView("staging_by_view")
    try:
        with pytest.raises(ValueError, match="TEMPORARY"):
            create_external_table(spark, "staging_by_view", staged)
    finally:
        spark.catalog.dropTempView("staging_by_view")


def test_an_external_table_follows_its_folder_and_leaves_the_files(spark, staged):
    table = f"{scratch_database(spark)}.sales_staging"
    other = write_staging_file(sales_from_rows(spark, ROWS[:1]), scratch_location(spark, "staging"))
    assert create_external_table(spark, table, other).count() == 1
    assert create_external_table(spark, table, staged).count() == 3  # a folder with an apostrophe
    spark.sql(f"DROP TABLE {table}")
    assert spark.read.parquet(staged).count() == 3 and spark.read.parquet(other).count() == 1


def test_databases_may_lie_in_any_folder(spark):
    name = f"{scratch_database(spark)}_b"
    create_database(spark, name, scratch_location(spark, "it's"))
    save_table(spark.range(2), f"{name}.t")
    assert spark.table(f"{name}.t").count() == 2


# --- listing ---


def test_everything_below_a_folder_is_listed(spark):
    root = tempfile.mkdtemp()
    sales_from_rows(spark, ROWS).write.partitionBy("category").parquet(f"{root}/t")
    os.makedirs(f"{root}/t/empty/deeper")
    for name, size in (("t/notes.txt", 3), ("t/category=home goods/zero", 0), ("t/empty/deeper/.hidden", 1), ("t/_SUCCESS.old", 5)):
        with open(f"{root}/{name}", "wb") as f:
            f.write(b"x" * size)
    found = {r.relative: r for r in list_folder(spark, f"file:{root}/", tasks=3).collect()}
    want = {os.path.relpath(os.path.join(d, n), root) for d, dirs, files in os.walk(root) for n in [*dirs, *files]}
    assert set(found) == want
    for name, r in found.items():
        path = os.path.join(root, name)
        assert r.kind == ("folder" if os.path.isdir(path) else "file")
        assert r.kind == "folder" or (r.size == os.path.getsize(path) and abs(r.modified.timestamp() - os.path.getmtime(path)) < 86_400)
    files = data_files(list_folder(spark, f"{root}/t"))
    assert {r.relative for r in files.collect() if not r.relative.endswith(".parquet")} == {"notes.txt", "category=home goods/zero"}
    values = {r.category for r in with_folder_values(files, ["category"]).collect()}
    assert values == {"home goods", "a/b +%é=x", None}
    parts = {r.category: (r.files, r.empty_files) for r in listed_partitions(files.where("relative LIKE 'category=%'"), ["category"]).collect()}
    assert parts["home goods"] == (2, 1) and parts[None] == (1, 0)
    for path in files.select("path").where("path LIKE '%.parquet'").collect():
        assert spark.read.parquet(path.path).count() == 1


def test_many_folders_are_listed_by_several_tasks(spark):
    root = tempfile.mkdtemp()
    for i in range(10_000):
        os.mkdir(f"{root}/{i}")
    listing = list_folder(spark, root)
    assert listing.rdd.getNumPartitions() > 1
    assert listing.where("kind = 'folder'").count() == 10_000
    used = listing.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(used) == 1  # the folders are flat: one call lists them all
    deep = tempfile.mkdtemp()
    for i in range(200):
        os.makedirs(f"{deep}/top/{i}/a")
    used = list_folder(spark, deep).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(used) > 1 and sum(r["count"] for r in used) == 401


def test_an_empty_folder_has_no_entries_and_a_missing_one_fails(spark):
    assert list_folder(spark, tempfile.mkdtemp()).count() == 0
    with pytest.raises(Exception, match="nowhere"):
        list_folder(spark, "/nowhere/at/all").count()


# --- partitions ---


def test_empty_partitions_are_counted(spark):
    one = spark.range(20).select(F.lit("x").alias("k"), "id").repartition(8, F.col("id") * 0)
    assert partition_count(one) == 8
    balance = [r.rows for r in whole_partition_balance(one).collect()]
    assert len(balance) == 8 and sorted(balance) == [0] * 7 + [20]
    assert partition_count(spark.range(5).coalesce(1)) == 1
    assert partition_count(spark.range(0, 10, 1, 3)) == 3


# --- exact sums ---


def sums(frame, keys=("k",)):
    totals = exact_totals(frame, keys).withColumn("s", exact_sum())
    return {tuple(r[k] for k in keys): (r.s, r.n_rows, r.n_ids, r.n_amounts, r.m) for r in totals.withColumn("m", exact_mean(F.col("s"))).collect()}


def test_sums_are_the_same_to_the_last_bit_for_any_division(spark):
    rows = spark.range(20_000).select("id", (F.col("id") % 7).alias("k"), ((F.rand(3) - 0.5) * F.pow(F.lit(10.0), F.col("id") % 30 - 12)).alias("amount"))
    rows = rows.checkpoint()
    found = []
    for width in (4, 200):
        spark.conf.set("spark.sql.shuffle.partitions", width)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            found.append(sums(rows.repartition(width, "id")))
        finally:
            spark.conf.unset("spark.sql.adaptive.enabled")
            spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert repr(sorted(found[0].items())) == repr(sorted(found[1].items()))
    by_k = {}
    for r in rows.collect():
        by_k.setdefault((r.k,), []).append(r.amount)
    assert {k: v[0] for k, v in found[0].items()} == {k: math.fsum(v) for k, v in by_k.items()}


CASES = {
    "cancel": [1e16, 1.0, -1e16, 3e-20], "tiny": [5e-324, 1e-310, -3e-320], "large": [1.7e308, -1.7e308, 1.0], "zeros": [0.0, -0.0],
    "null": [None, None], "some null": [None, 1.5], "tie": [1.0, 2.0**-53], "above a tie": [1.0, 2.0**-53, 2.0**-200],
    "below": [-1.0, -(2.0**-53), -(2.0**-200)], "powers": [2.0**e for e in range(-1074, 1000, 7)], "tenths": [0.1] * 10,
}


def test_hard_sums(spark):
    frame = spark.createDataFrame([(k, i, v) for k, vs in CASES.items() for i, v in enumerate(vs)], "k string, id int, amount double")
    got = sums(frame)
    for k, vs in CASES.items():
        kept = [v for v in vs if v is not None]
        assert got[(k,)][:4] == (math.fsum(kept) if kept else None, len(vs), len(vs), len(kept)), k
    odd = spark.createDataFrame([("n", 1, math.nan), ("n", 2, 1.0), ("i", 1, math.inf), ("i", 2, 1.0), ("b", 1, math.inf), ("b", 2, -math.inf)], "k string, id int, amount double")
    got = sums(odd)
    assert math.isnan(got[("n",)][0]) and got[("i",)][0] == math.inf and math.isnan(got[("b",)][0])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([None, "a", "b"]), st.integers(0, 3), st.one_of(st.none(), st.floats(-1e300, 1e300))), max_size=40))
def test_totals_merge_exactly(spark, rows):
    frame = spark.createDataFrame([(k, j, None if j == 0 else 1, v) for k, j, v in rows], "k string, j int, id int, amount double").repartition(3)
    merged = merged_totals(exact_totals(frame, ["k", "j"]), ["k"]).withColumn("s", exact_sum())
    for r in merged.collect():
        own = [(j, v) for k, j, v in rows if k == r.k]
        kept = [v for _, v in own if v is not None]
        assert (r.n_rows, r.n_ids, r.n_amounts) == (len(own), sum(j != 0 for j, _ in own), len(kept))
        assert r.s == (math.fsum(kept) if kept else None)
        assert (r.amount_min, r.amount_max) == ((min(kept), max(kept)) if kept else (None, None))
    assert merged.count() == len({k for k, _, _ in rows})
