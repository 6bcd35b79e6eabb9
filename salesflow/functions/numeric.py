"""Rounding and price bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesflow.schema import BAND_BUDGET, BAND_MID, BAND_PREMIUM, MID_FROM, PREMIUM_FROM


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_money(c: Column | str, scale: int = 2) -> Column:
    """HALF_UP rounding on the decimal text of the double (round(1.005, 2) = 1.01)."""
    return F.round(_col(c), scale)


def price_band(amount: Column | str, premium_from: float = PREMIUM_FROM, mid_from: float = MID_FROM) -> Column:
    """Premium if amount >= premium_from, else mid if >= mid_from, else budget.
    A NULL amount falls through to budget, as in the reference's CASE chain."""
    a = _col(amount)
    return (
        F.when(a >= F.lit(premium_from), F.lit(BAND_PREMIUM))
        .when(a >= F.lit(mid_from), F.lit(BAND_MID))
        .otherwise(F.lit(BAND_BUDGET))
    )
