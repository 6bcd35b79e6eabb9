"""Rows chosen by the keys of another frame, NULL keys included."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def _matched(df: DataFrame, keys: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    other = keys.select(*columns).toDF(*(f"_key_{c}" for c in columns))
    same = (df[c].eqNullSafe(other[f"_key_{c}"]) for c in columns)
    return df.join(other, reduce(lambda a, b: a & b, same), how)


def with_keys_of(df: DataFrame, keys: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows whose ``columns`` occur in ``keys`` (a semi join: rows are not multiplied, ``keys`` may repeat)."""
    return _matched(df, keys, columns, "left_semi")


def without_keys_of(df: DataFrame, keys: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows whose ``columns`` do not occur in ``keys``."""
    return _matched(df, keys, columns, "left_anti")
