"""Date parsing and date parts.

ANSI mode (on by default in Spark 4) raises on a bad date string; the
reference ran with it off, where a bad string becomes NULL. The try_ forms
give NULL whatever the session setting, so one bad row never fails a job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesflow.schema import DATE_FORMAT


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: Column | str, fmt: str | None = None) -> Column:
    """F1 without ``fmt``: cast rules ('2024-1-5' and '2024-01-15 10:00:00' parse).
    F2 with ``fmt``: the pattern must match exactly. Unparseable input gives NULL."""
    if fmt is None:
        return _col(c).try_cast("date")
    return F.try_to_date(_col(c), fmt)


def parse_sale_date(c: Column | str) -> Column:
    """F2 with the sales date layout."""
    return parse_date(c, DATE_FORMAT)


def year_of(d: Column | str) -> Column:
    """calendar year of a date as INT."""
    return F.year(_col(d))


def month_of(d: Column | str) -> Column:
    """month number of a date as INT."""
    return F.month(_col(d))


def year_text(d: Column | str) -> Column:
    """Year as STRING, the partition value written by the loaders."""
    return year_of(d).cast("string")


def month_text(d: Column | str) -> Column:
    """month as a two-character, zero-padded STRING ('01' .. '12')."""
    return F.lpad(month_of(d).cast("string"), 2, "0")
