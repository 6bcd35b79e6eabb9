"""The text pipeline over `documents`: each stage calls one operator of salesflow.llm on all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's `docs`. All stages but the last return the columns of `docs`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.llm.bpe_codec import codec_digests
from salesflow.llm.common import fresh_name, keep_one, table
from salesflow.llm.decontamination import decontaminate
from salesflow.llm.pii import redact_pii
from salesflow.llm.simhash import near_duplicates
from salesflow.llm.toxicity import drop_toxic, train
from salesflow.session import scratch_location


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that are predicted toxic; the model learns from the labels of `docs` that are not held out."""
    return drop_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps, of each group of linked fingerprints, the row with the least id; of an id's texts that with the least hash."""
    key = fresh_name(docs, "_key")
    marked = docs.withColumn(key, F.struct(
        F.col("doc_id").isNull().alias("without"), F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash")
    ))
    groups = near_duplicates(marked, shingle=3, bits=3, id_col=key)
    return keep_one(marked, groups.where(F.col(key) == F.col("component_id")).select(key), key).drop(key)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by the name of its kind in brackets, and counts the characters anew."""
    return redact_pii(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes what is left and decodes it again."""
    return codec_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("byte_bpe", bpe_stage),
]

#: A trained model, hash fingerprints and merges are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_location(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
