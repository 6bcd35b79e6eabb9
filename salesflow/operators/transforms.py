"""Row-wise transforms (P1-P6 with F1-F7). Each is one projection; Catalyst fuses them
with the scan, and columns a later step does not use are pruned from the read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.functions import (
    month_text,
    parse_date,
    parse_sale_date,
    price_band,
    round_money,
    title_case,
    year_text,
)
from salesflow.schema import MID_FROM, PREMIUM_FROM


def with_date_parts(df: DataFrame) -> DataFrame:
    """Aggregate-job transform.

    ``amount`` becomes DOUBLE, ``sale_date`` a DATE by cast rules, then ``year`` ('2024')
    and zero-padded ``month`` ('01') are appended as STRING. Replaced columns keep their place."""
    d = parse_date(F.col("sale_date"))
    return df.withColumns(
        {
            "amount": F.col("amount").cast("double"),
            "sale_date": d,
            "year": year_text(d),
            "month": month_text(d),
        }
    )


def with_partition_values(df: DataFrame, *more: str) -> DataFrame:
    """Projection of the partitioned load (P2, P4): the four data columns, then the partition
    values ``category``, ``year`` (STRING) and ``month`` (STRING, zero-padded) derived from the
    unparsed ``sale_date`` text. Partition columns go last, in table order; columns named in
    ``more`` follow them."""
    d = parse_date(F.col("sale_date"))
    return df.select(
        "id",
        "sale_date",
        "product",
        "amount",
        "category",
        year_text(d).alias("year"),
        month_text(d).alias("month"),
        *more,
    )


def clean_sales(df: DataFrame, premium_from: float = PREMIUM_FROM, mid_from: float = MID_FROM) -> DataFrame:
    """ETL transform.

    ``sale_date`` parsed strictly as 'yyyy-MM-dd', ``product`` title-cased, ``price_category``
    appended, ``amount`` rounded to cents. All four read the input columns, so the band
    is taken from the amount before rounding (999.995 is mid, stored as 1000.0)."""
    return df.withColumns(
        {
            "sale_date": parse_sale_date(F.col("sale_date")),
            "product": title_case(F.col("product")),
            "price_category": price_band(F.col("amount"), premium_from, mid_from),
            "amount": round_money(F.col("amount"), 2),
        }
    )
