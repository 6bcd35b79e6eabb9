"""Scratch folders come from spark.checkpoint.dir; without it, from the shared warehouse."""

from salesflow.session import _own_folder, scratch_location, shared_root


def test_own_folder_is_in_the_warehouse(spark):
    assert _own_folder(spark).startswith(spark.conf.get("spark.sql.warehouse.dir"))


def test_scratch_under_shared_root(spark):
    root = shared_root(spark)
    a, b = scratch_location(spark, "x"), scratch_location(spark, "x")
    assert a.startswith(root + "/salesflow/") and a != b
