"""The registered queries of the text operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .bpe_codec import codec_digests
from .common import table
from .decontamination import benchmark_leaks
from .html_text import extract_text
from .oracle import ORACLE_SQL
from .pii import find_pii
from .quality import quality_rules
from .repeats import without_repeats
from .secrets import scan_secrets
from .simhash import near_duplicates
from .token_counts import token_counts
from .top_k import top_hundredth
from .toxicity import toxicity
from .vector_codes import compressed_codes
from .whitening import whitened_components


def leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))


def toxic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, bits=3)


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return codec_digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compressed_codes(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_hundredth(table(spark, sf_dir, "embeddings"), k=10, every=100)


def whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_components(table(spark, sf_dir, "embeddings"), components=32)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_leaks": leaks,
    "op2_token_count": token_count,
    "op3_secret_scan": secret_scan,
    "op4_repeated_passages": repeats,
    "op5_toxicity": toxic_scores,
    "op6_pii": pii,
    "op7_quality_rules": quality,
    "op8_simhash": simhash_groups,
    "op9_html_text": html_text,
    "op10_byte_bpe": byte_bpe,
    "op11_vector_codes": vector_codes,
    "op12_top_k": nearest_vectors,
    "op13_whitening": whitening,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
