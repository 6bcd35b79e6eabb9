"""Changed-partition ETL, published generations, the load ledger, rejected rows: what a second, a failed and a repeated run do."""

import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

import salesflow.plans.incremental_etl as incremental
import salesflow.plans.ledger as ledger
import salesflow.plans.publish as publish
from salesflow import queries
from salesflow.operators import (
    StepCounts,
    compact_table,
    drop_partitions,
    file_listing,
    insert_into,
    partition_values,
    published_generation,
    save_sorted,
    save_table,
    table_location,
    with_partition_values,
)
from salesflow.plans import (
    drop_failed_loads,
    load_checked,
    load_once,
    load_partitioned,
    loaded_files,
    publish_etl,
    published_tables,
    reject_summary,
    run_etl,
    run_incremental_etl,
    stage_sales,
)
from salesflow.session import scratch_database, scratch_location
from salesflow.sources import sales_from_rows

NAMES = ("transformed", "by_category", "by_month")
ROWS = [
    (1, "2021-10-31", "wall clock", 1000.0, "home goods"),
    (2, "2021-10-02", "OIL lamp", 299.99, "home goods"),
    (3, "2022-01-09", "kettle", 300.0, "home goods"),
    (4, "2022-01-30", "gravel bike", 2499.5, "sport"),
    (5, "2021-10-17", "yoga mat", 20.25, "sport"),
    (6, "not a date", "mystery", None, None),
    (7, "2021-11-01", "it's 50%", 0.1, "a/b 'c' é"),
]


def rows_of(spark, table):
    return sorted(map(str, (r.asDict() for r in spark.table(table).collect())))


def paths(spark, table):
    root = table_location(spark, table).removeprefix("file:")
    return {os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


@pytest.fixture
def source(spark):
    """(partitioned table, its folder) of ROWS."""
    staging = stage_sales(sales_from_rows(spark, ROWS), scratch_location(spark, "staging"))
    table = load_partitioned(spark, scratch_database(spark), staging).partitioned_table
    return table, table_location(spark, table)


def add(spark, table, rows):
    insert_into(with_partition_values(sales_from_rows(spark, rows)), table)


def same_as_full_run(spark, tables, root):
    full = run_etl(spark, root, scratch_database(spark))
    for name in NAMES:
        assert rows_of(spark, getattr(tables, name)) == rows_of(spark, getattr(full, name)), name


# --- changed partitions ---


def test_a_changed_partition_rewrites_its_folders_only(spark, source):
    table, root = source
    database = scratch_database(spark)
    first = run_incremental_etl(spark, root, database)
    assert first.full and {r.status for r in first.changes.collect()} == {"changed"}
    same_as_full_run(spark, first.tables, root)
    before = {n: paths(spark, getattr(first.tables, n)) for n in NAMES}
    add(spark, table, [(8, "2022-01-05", "tent", 500.0, "sport"), (9, "2022-01-06", "rope", 0.2, "sport")])
    second = run_incremental_etl(spark, root, database)
    assert not second.full
    assert [tuple(r) for r in second.changes.collect()] == [("sport", 2022, 1, "changed")]
    same_as_full_run(spark, second.tables, root)
    after = {n: paths(spark, getattr(second.tables, n)) for n in NAMES}
    changed = {n: {os.path.dirname(p) for p in before[n] ^ after[n]} for n in NAMES}
    # the folder of sport's mid band is new; budget and premium hold rows of the changed partition
    assert changed["transformed"] == {f"category=sport/price_category={b}" for b in ("premium", "mid", "budget")}
    assert changed["by_month"] == {"year=2022/month=1"}


def test_bands_that_a_change_does_not_touch_stay(spark, source):
    table, root = source
    database = scratch_database(spark)
    tables = run_incremental_etl(spark, root, database).tables
    before = paths(spark, tables.transformed)
    add(spark, table, [(8, "2021-11-05", "tent", 500.0, "sport")])
    run_incremental_etl(spark, root, database)
    changed = {os.path.dirname(p) for p in before ^ paths(spark, tables.transformed)}
    assert changed == {"category=sport/price_category=mid"}


def test_nothing_changed_writes_nothing(spark, source):
    _, root = source
    database = scratch_database(spark)
    tables = run_incremental_etl(spark, root, database).tables
    state, before = published_generation(spark, database, incremental.NAME), {n: paths(spark, getattr(tables, n)) for n in NAMES}
    again = run_incremental_etl(spark, root, database)
    assert not again.full and again.changes.count() == 0
    assert published_generation(spark, database, incremental.NAME) == state
    assert {n: paths(spark, getattr(tables, n)) for n in NAMES} == before


def test_partitions_that_go_take_their_rows_along(spark, source):
    table, root = source
    database = scratch_database(spark)
    run_incremental_etl(spark, root, database)
    gone = partition_values(spark, table).where("category IS NULL OR category LIKE 'a/b%' OR (category = 'home goods' AND year = '2022')")
    assert drop_partitions(spark, table, gone) == 3
    run = run_incremental_etl(spark, root, database)
    assert {(r.category, r.year, r.month, r.status) for r in run.changes.collect()} == {
        (None, None, None, "gone"), ("a/b 'c' é", 2021, 11, "gone"), ("home goods", 2022, 1, "gone"),
    }
    same_as_full_run(spark, run.tables, root)
    assert not any("price_category=mid" in p and "home" in p for p in paths(spark, run.tables.transformed))


def test_a_file_replaced_by_one_of_equal_rows_counts_as_changed(spark, source):
    table, root = source
    database = scratch_database(spark)
    run_incremental_etl(spark, root, database)
    load = spark.table(table).where("category = 'sport' AND year = '2021'").withColumn("amount", F.lit(21.0))
    from salesflow.operators import overwrite_partitions

    overwrite_partitions(load.checkpoint(), table)
    run = run_incremental_etl(spark, root, database)
    assert [r.category for r in run.changes.collect()] == ["sport"]
    same_as_full_run(spark, run.tables, root)


@pytest.mark.parametrize("step", ["overwrite_partitions", "drop_partitions", "category_summary_of"])
def test_a_run_that_fails_is_made_good_by_the_next(spark, source, monkeypatch, step):
    table, root = source
    database = scratch_database(spark)
    run_incremental_etl(spark, root, database)
    add(spark, table, [(8, "2022-01-05", "tent", 500.0, "sport")])

    def fail(*args, **more):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(incremental, step, fail)
        with pytest.raises(OSError, match="lost"):
            run_incremental_etl(spark, root, database)
    run = run_incremental_etl(spark, root, database)
    assert run.changes.count() == 1
    same_as_full_run(spark, run.tables, root)


def test_other_bands_than_last_time_do_everything(spark, source):
    _, root = source
    database = scratch_database(spark)
    run_incremental_etl(spark, root, database)
    run = run_incremental_etl(spark, root, database, premium_from=100.0, mid_from=1.0)
    assert run.full
    full = run_etl(spark, root, scratch_database(spark), premium_from=100.0, mid_from=1.0)
    assert rows_of(spark, run.tables.transformed) == rows_of(spark, full.transformed)


def test_only_changed_partitions_are_read(spark, source):
    table, root = source
    rows = incremental.extract(spark, root)
    changes = spark.createDataFrame([("sport", 2022, 1, "changed")], "category string, year int, month int, status string")
    save_table(changes, f"{scratch_database(spark)}.changes")
    read = incremental.with_keys_of(rows, changes.where("status = 'changed'"), incremental.SOURCE_KEYS)
    assert [r.id for r in read.collect()] == [4]
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


# --- three tables as one ---


def test_a_failure_between_tables_leaves_readers_on_the_old_three(spark, source, monkeypatch):
    table, root = source
    database = scratch_database(spark)
    with pytest.raises(LookupError):
        publish_etl(spark, root, database) and published_tables(spark, scratch_database(spark))
    old = published_tables(spark, database)
    kept = {n: rows_of(spark, getattr(old, n)) for n in NAMES}
    add(spark, table, [(8, "2022-01-05", "tent", 500.0, "sport")])
    import salesflow.plans.etl as etl

    written, real = [], etl.save_table

    def fail_third(df, name, **more):
        if len(written) == 2:
            raise OSError("lost")
        real(df, name, **more)
        written.append(name)

    with monkeypatch.context() as m:
        m.setattr(etl, "save_table", fail_third)
        with pytest.raises(OSError, match="lost"):
            publish_etl(spark, root, database)
    assert len(written) == 2 and not any(spark.catalog.tableExists(t) for t in written)
    assert published_tables(spark, database) == old
    assert {n: rows_of(spark, getattr(old, n)) for n in NAMES} == kept
    new = publish_etl(spark, root, database)
    assert published_tables(spark, database) == new != old
    same_as_full_run(spark, new, root)
    assert rows_of(spark, old.by_month) == kept["by_month"]  # one generation stays for readers that have begun
    publish_etl(spark, root, database)
    assert not spark.catalog.tableExists(old.by_month) and spark.catalog.tableExists(new.by_month)


def test_two_runs_never_mix(spark, source):
    _, root = source
    database = scratch_database(spark)
    publish_etl(spark, root, database)
    with pytest.raises(RuntimeError, match="meanwhile"):
        with publish.next_generation(spark, database, publish.NAME, publish.ETL_TABLE_NAMES) as made:
            save_table(spark.range(1), made.table("sales_by_month"))
            other = publish_etl(spark, root, database)
    assert published_tables(spark, database) == other
    assert not spark.catalog.tableExists(made.made[0])


def test_steps_are_counted_while_tables_are_written(spark, source):
    _, root = source
    counts = StepCounts()
    run_etl(spark, root, scratch_database(spark), counts=counts)
    assert [(r.step, r.rows) for r in counts.table(spark).orderBy("position").collect()] == [
        ("extract", 7), ("transform", 7), ("by_category", 4), ("by_month", 6),
    ]
    with pytest.raises(ValueError, match="watched already"):
        counts.watch(spark.range(1), "extract")


# --- the load ledger ---


@pytest.fixture
def staging(spark):
    return stage_sales(sales_from_rows(spark, ROWS[:4]).coalesce(2), scratch_location(spark, "staging"))


def more(spark, staging, rows):
    sales_from_rows(spark, rows).coalesce(1).write.mode("append").parquet(staging)


def ids(spark, tables):
    return sorted(r.id for r in spark.table(tables.view).select("id").collect())


def test_the_same_folder_twice_is_one_copy_and_rewrites_nothing(spark, staging):
    database = scratch_database(spark)
    tables = load_once(spark, database, staging)
    before = paths(spark, tables.rows)
    load_once(spark, database, staging)
    assert ids(spark, tables) == [1, 2, 3, 4] and paths(spark, tables.rows) == before
    more(spark, staging, ROWS[4:])
    load_once(spark, database, staging)
    assert ids(spark, tables) == [1, 2, 3, 4, 5, 6, 7] and before < paths(spark, tables.rows)
    assert spark.table(tables.view).columns == ["id", "sale_date", "product", "amount", "category", "year", "month"]
    assert spark.table(tables.loads).count() == 2
    assert loaded_files(spark, tables).count() == sum(f.endswith(".parquet") for f in os.listdir(staging.removeprefix("file:")))


@pytest.mark.parametrize("at", [0, 1, 2])
def test_a_load_that_fails_shows_nothing_and_is_done_again(spark, staging, monkeypatch, at):
    """After the rows, after the files, and within the commit."""
    database = scratch_database(spark)
    tables = load_once(spark, database, staging)
    more(spark, staging, ROWS[4:])
    done, real = [], ledger.insert_into

    def fail(df, table, **kind):
        if len(done) == at:
            raise OSError("lost")
        real(df, table, **kind)
        done.append(table)

    with monkeypatch.context() as m:
        if at < 2:
            m.setattr(ledger, "insert_into", fail)
        else:
            m.setattr(type(spark), "range", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            load_once(spark, database, staging)
    assert ids(spark, tables) == [1, 2, 3, 4]
    load_once(spark, database, staging)
    assert ids(spark, tables) == [1, 2, 3, 4, 5, 6, 7]
    assert drop_failed_loads(spark, tables) == []  # too young
    dropped = drop_failed_loads(spark, tables, timedelta(seconds=-5))
    assert len(dropped) == (1 if at else 0)
    loads = {r.load_id for r in spark.table(tables.loads).collect()}
    assert {r.load_id for r in partition_values(spark, tables.rows).collect()} == loads
    assert ids(spark, tables) == [1, 2, 3, 4, 5, 6, 7]


def test_a_file_rewritten_in_place_is_refused(spark, staging):
    database = scratch_database(spark)
    load_once(spark, database, staging)
    folder = staging.removeprefix("file:")
    name = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))[0]
    os.utime(os.path.join(folder, name), (1, 1))
    with pytest.raises(ValueError, match="changed since"):
        load_once(spark, database, staging)


# --- rejected rows, sorted and compacted files ---


def test_good_and_rejected_rows_add_up(spark):
    odd = [*ROWS, (8, None, "a", 1.0, "sport"), (9, "2022-1-5", "b", 1.0, "sport"), (10, "2022-01-05 10:00:00", "c", 1.0, "x")]
    staging = stage_sales(sales_from_rows(spark, odd), scratch_location(spark, "staging"))
    tables = load_checked(spark, scratch_database(spark), staging, scratch_location(spark, "checked"))
    assert sorted(r.id for r in spark.table(tables.good).collect()) == [1, 2, 3, 4, 5, 7]
    assert {(r.id, r.reason, r.year, r.month) for r in spark.table(tables.rejected).collect()} == {
        (6, "not a date", None, None), (8, "no date", None, None),
        (9, "date not as yyyy-MM-dd", "2022", "01"), (10, "date not as yyyy-MM-dd", "2022", "01"),
    }
    assert sum(r.rows for r in reject_summary(spark, tables).collect()) + spark.table(tables.good).count() == len(odd)
    good = stage_sales(sales_from_rows(spark, ROWS[:5]), scratch_location(spark, "staging"))
    tables = load_checked(spark, scratch_database(spark), good, scratch_location(spark, "checked"))
    assert (spark.table(tables.good).count(), spark.table(tables.rejected).count()) == (5, 0)


def test_sorted_files_hold_ranges_that_a_filter_can_skip(spark):
    import pyarrow.parquet as pq

    database = scratch_database(spark)
    # key 500 holds a third of all rows
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 1000).alias("k"), (F.col("id") % 2).alias("p"), "id")
    for table, parts in ((f"{database}.flat", []), (f"{database}.parts", ["p"])):
        save_sorted(rows, table, ["k"], parts, writers=16)
        root = table_location(spark, table).removeprefix("file:")
        folders = {}
        for path in paths(spark, table):
            found = pq.read_table(os.path.join(root, path), columns=["k"], partitioning=None)["k"].to_pylist()
            assert found == sorted(found)
            folders.setdefault(os.path.dirname(path), []).append((found[0], found[-1]))
        for ranges in folders.values():
            ranges.sort()
            assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
            assert sum(a <= 10 <= z for a, z in ranges) == 1
        assert sum(map(len, folders.values())) >= 16
        assert spark.table(table).count() == 30_000
        largest = spark.table(table).groupBy("_metadata.file_path").count().agg(F.max("count")).first()[0]
        assert largest < 6_000  # the hot key is cut


def test_sorted_files_grow_in_number_not_in_size(spark):
    database = scratch_database(spark)
    for n in (4_000, 32_000):
        rows = spark.range(n).select(
            (F.col("id") % 977).alias("k"), F.repeat(F.lit("x"), 200).alias("t"), F.array(F.lit("y" * 100)).alias("a"),
            F.when(F.col("id") % 2 == 0, F.lit("z")).alias("n"), F.lit(b"b").alias("b"), "id",
        )
        save_sorted(rows, f"{database}.sorted_{n}", ["k"], writers=2, target_bytes=400_000)
        saved = spark.table(f"{database}.sorted_{n}")
        assert sorted(saved.select("k", "t", "a", "n", "b", "id").collect(), key=lambda r: r.id) == sorted(rows.collect(), key=lambda r: r.id)
        files = [r.rows for r in file_listing(saved, ()).collect()]
        assert n // 1_500 <= len(files) <= n // 500 and max(files) < 2_000
    save_sorted(rows.where("id < 0"), f"{database}.empty", ["k"], writers=2)
    assert spark.table(f"{database}.empty").count() == 0


def test_sorted_table_is_checked_without_a_sort_of_its_rows(spark, tmp_path):
    """A sort between the scan and the first exchange holds a scan task's rows."""
    day = F.when(F.col("id") % 50 != 7, F.date_add(F.lit("1995-01-01").cast("date"), F.pmod("id", F.lit(300)).cast("int")))
    spark.range(3_000).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 10).alias("l_partkey"), F.lit(1.5).alias("l_extendedprice"), day.alias("l_shipdate")
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(10).selectExpr("id AS p_partkey", "concat('part ', id) AS p_name", "'STEEL' AS p_type").write.parquet(f"{tmp_path}/part.parquet")
    query = queries.sales_sorted_table(spark, str(tmp_path))
    assert [tuple(r) for r in query.collect()] == [(3_000, True, False)]
    plan = query._jdf.queryExecution().executedPlan().toString().splitlines()
    scan = max(i for i, line in enumerate(plan) if "FileScan" in line)
    exchange = max(i for i, line in enumerate(plan[:scan]) if "Exchange" in line)
    between = plan[exchange + 1 : scan]
    assert any("HashAggregate" in line for line in between) and not any("Sort" in line for line in between)


def test_compaction_keeps_rows_and_leaves_large_partitions(spark):
    table = f"{scratch_database(spark)}.small"
    rows = spark.range(6000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t"), F.when(F.col("id") % 3 != 0, F.col("id") % 3).alias("p"))
    for part in range(4):
        save_table(rows.where(F.col("id") % 4 == part), table, ["p"], "append" if part else "overwrite")
    save_table(rows.withColumn("p", F.lit(9)).coalesce(1), table, ["p"], "append")
    alone = {p for p in paths(spark, table) if p.startswith("p=9")}
    sizes = file_listing(spark.table(table), ["p"]).collect()
    wanted = spark.table(table).orderBy("p", "id").collect()
    target = 3 * max(r.file_size for r in sizes if r.p != 9)
    assert compact_table(spark, table, target) == 3
    after = file_listing(spark.table(table), ["p"]).groupBy("p").count().collect()
    files = {r.p: r["count"] for r in after if r.p != 9}
    assert set(files) == {None, 1, 2} and all(1 <= n <= 2 for n in files.values())
    assert alone <= paths(spark, table)
    assert spark.table(table).orderBy("p", "id").collect() == wanted
    assert compact_table(spark, table, target) == 0
