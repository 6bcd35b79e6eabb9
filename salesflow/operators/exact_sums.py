"""Sums of doubles that do not depend on the order of addition (G1-G4), in built-in functions.

A double is a whole number times a power of two. Each value is written as ``(hi * 2**43 + lo) * 2**(32 * bin)`` with whole
``hi`` and ``lo``, so sums of ``hi`` and ``lo`` by bin are exact (decimals), and so are sums of those sums: totals merge
exactly, however the rows were divided. The sum is rounded once, at the end, to the nearest double.

NULL values are skipped, as by ``sum``; NaN and infinities add up as doubles do. A group has as many bins as its values
have ranges of 32 binary exponents: at most 66, and one or two for amounts of money.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Binary exponents of a bin, and bits of `lo`.
STEP, SPLIT = 32, 43
NUMBER = "decimal(38,0)"
#: Places above the highest bin that carries may reach.
HEADROOM = 6
TOTAL_COLUMNS = ("n_rows", "n_ids", "n_amounts", "amount_bins", "amount_special", "amount_min", "amount_max")


def times_power_of_two(x: Column, exponent: Column) -> Column:
    """x * 2**exponent in two steps, each of which stays in range; exact unless the result is too small."""
    half = F.floor(exponent / 2)
    return x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), exponent - half)


def _finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def bin_of(x: Column) -> Column:
    """The bin of a finite value other than 0: its lowest bit is not below the bin, whatever ``log2`` rounds."""
    return F.floor((F.floor(F.log2(F.abs(x))) - 54) / STEP).cast("int")


def exact_totals(df: DataFrame, keys: Sequence[str], amount: str = "amount", id_col: str = "id") -> DataFrame:
    """For each group: rows, ids and amounts that are not NULL, and the amounts' exact sum (as bins), least and largest.

    Two steps, each with a partial one before its shuffle: by keys and bin, then by keys."""
    x = F.col("_x")
    rows = df.select(*keys, F.col(id_col).alias("_id"), F.col(amount).cast("double").alias("_x"))
    rows = rows.withColumn("_bin", F.when(_finite(x) & (x != 0), bin_of(x)))
    scaled = times_power_of_two(x, F.col("_bin") * -STEP)
    hi = F.floor(scaled / 2**SPLIT)
    parts = {"_hi": hi.cast("long"), "_lo": (scaled - hi.cast("double") * 2**SPLIT).cast("long")}
    binned = rows.withColumns({k: F.when(F.col("_bin").isNotNull(), v) for k, v in parts.items()})
    by_bin = binned.groupBy(*keys, "_bin").agg(
        F.count("*").alias("n_rows"),
        F.count("_id").alias("n_ids"),
        F.count("_x").alias("n_amounts"),
        F.sum(F.col("_hi").cast("decimal(20,0)")).cast(NUMBER).alias("hi"),
        F.sum(F.col("_lo").cast("decimal(20,0)")).cast(NUMBER).alias("lo"),
        F.sum(F.when(~_finite(x), x)).alias("amount_special"),
        F.min("_x").alias("amount_min"),
        F.max("_x").alias("amount_max"),
    )
    return _by_keys(by_bin.withColumnRenamed("_bin", "bin"), keys)


def _by_keys(by_bin: DataFrame, keys: Sequence[str]) -> DataFrame:
    bins = F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "hi", "lo")))
    return by_bin.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_ids").alias("n_ids"),
        F.sum("n_amounts").alias("n_amounts"),
        F.array_sort(bins).alias("amount_bins"),
        F.sum("amount_special").alias("amount_special"),
        F.min("amount_min").alias("amount_min"),
        F.max("amount_max").alias("amount_max"),
    )


def merged_totals(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``exact_totals`` of fewer keys, from those of more: counts, bins, least and largest combine exactly."""
    once = (F.col("pos").isNull()) | (F.col("pos") == 0)  # what is not by bin counts with a group's first bin only
    flat = totals.select(*keys, *TOTAL_COLUMNS, F.posexplode_outer("amount_bins").alias("pos", "b")).select(
        *keys, F.col("b.bin").alias("bin"), F.col("b.hi").alias("hi"), F.col("b.lo").alias("lo"),
        *(F.when(once, F.col(c)).alias(c) for c in TOTAL_COLUMNS if c != "amount_bins"),
    )
    by_bin = flat.groupBy(*keys, "bin").agg(
        *(F.sum(c).alias(c) for c in ("n_rows", "n_ids", "n_amounts", "amount_special")),
        *(F.sum(c).cast(NUMBER).alias(c) for c in ("hi", "lo")),
        F.min("amount_min").alias("amount_min"),
        F.max("amount_max").alias("amount_max"),
    )
    return _by_keys(by_bin, keys)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _digits(places: Column, values: Column, sign: int) -> Column:
    """``carry, digits`` of a sum: what each place holds is brought below 2**32, and the rest carried to the next."""
    zero, base = F.lit(0).cast(NUMBER), F.lit(2**STEP).cast(NUMBER)

    def step(state: Column, place: Column) -> Column:
        held = (F.coalesce(F.try_element_at(values, place), zero) * sign + state["carry"]).cast(NUMBER)

        def split(t: Column) -> Column:
            digit = F.pmod(t, base).cast(NUMBER)
            carry = ((t - digit).cast(NUMBER) / base).cast(NUMBER)
            return F.struct(carry.alias("carry"), F.concat(state["digits"], F.array(digit.cast("long"))).alias("digits"))

        return _let(held, split)

    return F.aggregate(places, F.struct(zero.alias("carry"), F.array().cast("array<long>").alias("digits")), step)


def _rounded(digits: Column, first: Column) -> Column:
    """The nearest double to a sum of digits from place ``first`` on: the three highest digits in use, and whether
    anything is left below them."""

    def digit(i: Column) -> Column:
        return F.when(i >= 0, F.get(digits, i)).otherwise(0).cast(NUMBER)

    def of(top: Column) -> Column:
        head = (digit(top) * F.lit(str(2**64)).cast("decimal(20,0)")).cast(NUMBER)
        head = (head + (digit(top - 1) * F.lit(2**32)).cast(NUMBER) + digit(top - 2)).cast(NUMBER)
        below = F.exists(F.slice(digits, 1, F.greatest(top - 2, F.lit(0))), lambda d: d != 0)
        odd = _let(head, lambda h: (h + F.when(below & (F.pmod(h, F.lit(2)) == 0), 1).otherwise(0)).cast(NUMBER))
        return F.when(top < 0, F.lit(0.0)).otherwise(times_power_of_two(odd.cast("double"), (first + top - 2) * STEP))

    return _let(F.array_max(F.transform(digits, lambda d, i: F.when(d != 0, i).otherwise(-1))), of)


def exact_sum(bins: Column | str = "amount_bins", special: Column | str = "amount_special", count: Column | str = "n_amounts") -> Column:
    """The sum of a group as the nearest double; NULL where no value counts.

    Carries bring the bins to digits of 32 bits, the same whatever the bins were; a negative sum is taken with its sign
    turned."""
    bins, special, count = (F.col(c) if isinstance(c, str) else c for c in (bins, special, count))
    # hi * 2**43 of one bin is hi * 2**11 of the next
    held = F.concat(
        F.transform(bins, lambda b: F.struct(b["bin"].alias("place"), b["lo"].alias("value"))),
        F.transform(bins, lambda b: F.struct((b["bin"] + 1).alias("place"), (b["hi"] * 2 ** (SPLIT - STEP)).cast(NUMBER).alias("value"))),
    )
    first = F.array_min(F.transform(bins, lambda b: b["bin"]))
    last = F.array_max(F.transform(bins, lambda b: b["bin"])) + HEADROOM

    def at(place: Column) -> Column:
        own = F.filter(held, lambda h: h["place"] == place)
        return F.aggregate(own, F.lit(0).cast(NUMBER), lambda a, h: (a + h["value"]).cast(NUMBER))

    def total(places: Column) -> Column:
        return _let(
            F.map_from_arrays(places, F.transform(places, at)),
            lambda values: _let(
                _digits(places, values, 1),
                lambda plus: F.when(plus["carry"] < 0, -_rounded(_digits(places, values, -1)["digits"], first)).otherwise(
                    _rounded(plus["digits"], first)
                ),
            ),
        )

    finite = F.when(F.size(bins) == 0, F.lit(0.0)).otherwise(_let(F.sequence(first, last), total))
    return F.when(count > 0, F.coalesce(special, finite))


def exact_mean(total: Column, count: Column | str = "n_amounts") -> Column:
    """The mean from the exact sum; NULL where no value counts."""
    return F.try_divide(total, F.col(count) if isinstance(count, str) else count)
