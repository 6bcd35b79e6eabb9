"""Column functions: all built-in Spark expressions, so they stay inside whole-stage codegen."""

from salesflow.functions.dates import (
    month_of,
    month_text,
    parse_date,
    parse_sale_date,
    year_of,
    year_text,
)
from salesflow.functions.numeric import price_band, round_money
from salesflow.functions.text import title_case

__all__ = [
    "month_of",
    "month_text",
    "parse_date",
    "parse_sale_date",
    "price_band",
    "round_money",
    "title_case",
    "year_of",
    "year_text",
]
