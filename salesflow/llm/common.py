"""Helpers that the text operators share."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns that an operator reads, so that no other column of `docs` can clash; null text is empty."""
    return docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def map_texts(
    docs: DataFrame, id_col: str, text_col: str, fields: str, prepare: Callable[[], Callable[[list], dict]]
) -> DataFrame:
    """One output row per document: its id and `fields` (a DDL string).

    `prepare` runs once a task and returns a function from a list of whole texts to a list per field. Null
    ids stay null, equal ids stay separate rows, and an empty input gives an empty output. Batches are as
    large as Arrow makes them, so memory is bounded by a batch, or by one document where that is larger.
    """
    pairs = id_and_text(docs, id_col, text_col)
    kind = pairs.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = prepare()
        for batch in batches:
            if batch.num_rows:
                made = work(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(v, type=TYPES[kinds[k]]) for k, v in made.items())], [id_col, *made]
                )

    kinds = dict(f.split() for f in fields.split(", "))
    return pairs.mapInArrow(run, f"`{id_col}` {kind}, {fields}")


#: Arrow types of the DDL types that the operators use.
TYPES = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(),
    "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
}


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


#: Texts beyond this many characters are worked on in pieces, so that what a task holds stays bounded by the text.
SEGMENT = 1 << 20
_CUT = re.compile(r"\S(?=\s)")


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """Cuts a text before runs of white space, where every tokenizer pattern used here ends a match."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size - 1)
        if not cut:
            break
        yield text[at : cut.end()]
        at = cut.end()
    yield text[at:] if at else text


def cut_lineage(frame: DataFrame) -> DataFrame:
    """Writes a frame once to the shared checkpoint folder, and reads it from there from now on."""
    shared_root(frame.sparkSession)
    return frame.checkpoint()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): the root is the least node that can be reached.

    Large-star and small-star rounds until nothing changes, a few even for long chains; each round is two
    aggregations and joins over the links, and no group of links is ever gathered in one row.
    """
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    ordered, sign = cut_lineage(ordered), None
    while True:
        now = ordered.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == sign or not now[0]:
            break
        sign = now
        both = ordered.union(ordered.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ordered = cut_lineage(small.union(least.select("a", F.col("m").alias("b"))).distinct())
    roots = ordered.select("b").distinct()
    return ordered.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root"))
    )


def fresh_name(frame: DataFrame, name: str) -> str:
    while name in frame.columns:
        name += "_"
    return name


def filter_texts(docs: DataFrame, text_col: str, prepare: Callable[[], Callable[[list], list[bool]]]) -> DataFrame:
    """The rows, with all their columns, whose whole text is to stay; `prepare` runs once a task and returns a
    function from a list of texts (null: empty) to a list of verdicts. Nothing is shuffled."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = prepare()
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(work([x or "" for x in batch.column(at).to_pylist()]), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def keep_one(docs: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """The rows whose id is in the one column of `ids`, one row for each id (of several, the least by all columns);
    rows without an id can't be told apart, and stay."""
    name, count = fresh_name(docs, "_id"), fresh_name(docs, "_count")
    wanted = ids.toDF(name).groupBy(name).agg(F.count("*").alias(count)).hint("shuffle_hash")
    found = docs.join(wanted, docs[id_col] == F.col(name)).drop(name)
    columns = [f"`{c}`" for c in docs.columns]
    several = found.where(F.col(count) > 1).groupBy(id_col).agg(F.min(F.struct(*columns)).alias(count))
    several = several.select(*(F.col(count)[c].alias(c) for c in docs.columns))
    return found.where(F.col(count) == 1).select(*columns).unionByName(several).unionByName(docs.where(F.col(id_col).isNull()))
