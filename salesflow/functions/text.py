"""String functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_case(c: Column | str) -> Column:
    """upper-case the first letter of each space-separated word, lower-case the rest.
    Only spaces split words: 'blue t-shirt XL' -> 'Blue T-shirt Xl'. NULL stays NULL."""
    return F.initcap(F.col(c) if isinstance(c, str) else c)
