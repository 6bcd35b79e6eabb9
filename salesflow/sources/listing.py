"""Recursive folder listing (C6) as a Spark data source: every file and folder, hidden, empty and non-Parquet ones too.

The listing is a DataFrame and never passes through the driver: the driver looks for enough folders to share out, level
by level, and keeps only their names; the tasks list them, one folder in memory at a time. Stores that pyarrow cannot
open are listed by Spark's own file index instead, which knows neither hidden files nor folders.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "salesflow_folder"
LISTING_SCHEMA = "path string, relative string, kind string, size long, modified timestamp"
#: Folder name of a NULL partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def open_root(root: str) -> tuple[fs.FileSystem, str]:
    """The store of a folder, and the folder's path in it."""
    local = re.sub(r"^file:/+", "/", root)
    if local.startswith("/"):
        return fs.LocalFileSystem(), local.rstrip("/") or "/"
    store, path = fs.FileSystem.from_uri(root)
    return store, path.rstrip("/")


class FolderShare(InputPartition):
    """Folders of one task: `flat` ones without what is below their folders, `deep` ones with everything."""

    def __init__(self, flat: list[str], deep: list[str]):
        self.flat, self.deep = flat, deep


class FolderReader(DataSourceReader):
    def __init__(self, root: str, tasks: int):
        self.root, self.tasks = root, tasks

    def partitions(self) -> list[FolderShare]:
        store, top = open_root(self.root)
        flat, deep = [], [top]
        while deep and len(deep) < self.tasks:
            below = [i.path for d in deep for i in store.get_file_info(fs.FileSelector(d)) if i.type == fs.FileType.Directory]
            flat, deep = flat + deep, below
        deep.sort()
        n = max(1, min(self.tasks, len(flat) + len(deep)))
        return [FolderShare(flat[i::n], deep[i::n]) for i in range(n)]

    def read(self, partition: FolderShare) -> Iterator[pa.RecordBatch]:
        store, top = open_root(self.root)
        shown = self.root.rstrip("/")
        todo = [(d, False) for d in partition.flat] + [(d, True) for d in partition.deep]
        while todo:
            folder, deep = todo.pop()
            found = store.get_file_info(fs.FileSelector(folder))
            if deep:
                todo += [(i.path, True) for i in found if i.type == fs.FileType.Directory]
            relative = [i.path[len(top) :].lstrip("/") for i in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{shown}/{r}" for r in relative], pa.string()),
                    pa.array(relative, pa.string()),
                    pa.array(["folder" if i.type == fs.FileType.Directory else "file" for i in found], pa.string()),
                    pa.array([i.size for i in found], pa.int64()),
                    pa.array([i.mtime for i in found], pa.timestamp("us", tz="UTC")),
                ],
                ["path", "relative", "kind", "size", "modified"],
            )


class FolderSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return LISTING_SCHEMA

    def reader(self, schema) -> FolderReader:
        return FolderReader(self.options["path"], int(self.options["tasks"]))


def spark_listing(spark: SparkSession, root: str) -> DataFrame:
    """The files that Spark's own index finds: no folders, and no names that start with '_' or '.'."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    inside = F.regexp_replace("path", F.lit(f"^.*?{re.escape(root.rstrip('/').split(':')[-1].lstrip('/'))}/"), F.lit(""))
    return found.select(
        "path", inside.alias("relative"), F.lit("file").alias("kind"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )


def list_folder(spark: SparkSession, root: str, tasks: int | None = None) -> DataFrame:
    """Everything below ``root``: ``path, relative, kind`` ('file' or 'folder'), ``size, modified``, by up to ``tasks``
    tasks (default: four for each core). A folder that does not exist fails the read."""
    try:
        open_root(root)
    except pa.ArrowInvalid:  # a kind of store that only Spark knows
        return spark_listing(spark, root)
    spark.dataSource.register(FolderSource)
    return spark.read.format(FORMAT).option("tasks", tasks or 4 * spark.sparkContext.defaultParallelism).load(root)


def data_files(listing: DataFrame) -> DataFrame:
    """The files that a read of the folder sees: none below or called a name that starts with '_' or '.'."""
    hidden = F.col("relative").rlike(r"(^|/)(\.|_(?![^/]*=))")
    return listing.where((F.col("kind") == "file") & ~hidden)


def folder_value(relative: Column, column: str) -> Column:
    """The value of a ``column=value`` folder, unescaped; NULL for the folder of NULL."""
    raw = F.regexp_extract(relative, rf"(?:^|/){re.escape(column)}=([^/]*)", 1)
    plain = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    return F.when((raw != "") & (raw != NULL_FOLDER), plain)


def with_folder_values(listing: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listing with the partition values of each path as STRING columns."""
    return listing.withColumns({c: folder_value(F.col("relative"), c) for c in columns})


def listed_partitions(listing: DataFrame, columns: Sequence[str]) -> DataFrame:
    """C6 of a table's folder: files, those without a byte, and bytes for each partition, from the listing alone."""
    files = with_folder_values(data_files(listing), columns)
    return files.groupBy(*columns).agg(
        F.count("*").alias("files"), F.count_if(F.col("size") == 0).alias("empty_files"), F.sum("size").alias("bytes")
    )
