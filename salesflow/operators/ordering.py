"""Sort and first rows (O1-O3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def sort_rows(df: DataFrame, *keys: str) -> DataFrame:
    """O1/O2: ascending sort on one or more keys (a range exchange, then a local sort).
    Sort where the rows are read: a sort before a table write promises no order to readers."""
    return df.orderBy(*keys)


def first_rows(df: DataFrame, n: int = 20, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows. With ``order_by`` the choice is deterministic and
    runs as a per-task top-n plus a merge of ``n`` rows per task, not a full sort."""
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)
