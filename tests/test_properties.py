"""Property tests: Spark results against plain-Python brute force on generated rows."""

import datetime as dt
import os
import re
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from salesflow.operators import (
    category_summary,
    category_summary_from_totals,
    clean_sales,
    monthly_summary,
    monthly_summary_from_totals,
    monthly_totals,
    with_date_parts,
)
from salesflow.sources import sales_from_rows

SETTINGS = settings(
    max_examples=int(os.environ.get("PROPERTY_EXAMPLES", "20")),
    derandomize=True,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)

dates = st.one_of(
    st.none(),
    st.builds(lambda y, m, d: f"{y:04d}-{m:02d}-{d:02d}", st.integers(1990, 2030), st.integers(0, 13), st.integers(0, 32)),
    st.builds(lambda y, m, d: f"{y}-{m}-{d}", st.integers(1990, 2030), st.integers(1, 12), st.integers(1, 9)),
    st.sampled_from(["garbage", "", "2024-01-15 10:00:00", "2024/01/15"]),
)
words = st.text(alphabet="abcXYZ-019", min_size=0, max_size=6)
products = st.one_of(st.none(), st.lists(words, min_size=1, max_size=3).map(" ".join))
amounts_3dp = st.one_of(st.none(), st.integers(-2_000_000, 200_000_000).map(lambda k: k / 1000))
categories = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))


def strict_date(s):
    if s is None or not re.fullmatch(r"\d{4}-\d{2}-\d{2}", s):
        return None
    try:
        return dt.date(int(s[:4]), int(s[5:7]), int(s[8:]))
    except ValueError:
        return None


def title(s):
    if s is None:
        return None
    low = s.lower()
    return "".join(c.upper() if i == 0 or low[i - 1] == " " else c for i, c in enumerate(low))


def round2(x):
    if x is None:
        return None
    return float(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def band(x, premium=1000.0, mid=300.0):
    if x is not None and x >= premium:
        return "premium"
    if x is not None and x >= mid:
        return "mid"
    return "budget"


@SETTINGS
@given(st.lists(st.tuples(dates, products, amounts_3dp, categories), min_size=1, max_size=25))
def test_clean_sales_matches_brute_force(spark, rows):
    data = [(i, d, p, a, c) for i, (d, p, a, c) in enumerate(rows)]
    got = [tuple(r) for r in clean_sales(sales_from_rows(spark, data)).orderBy("id").collect()]
    want = [(i, strict_date(d), title(p), round2(a), c, band(a)) for i, d, p, a, c in data]
    assert got == want


amounts_int = st.one_of(st.none(), st.integers(-1000, 100_000).map(float))
iso_dates = st.builds(lambda m, d: f"2024-{m:02d}-{d:02d}", st.integers(1, 3), st.integers(1, 28))


def brute_summary(rows, keys):
    groups = {}
    for r in rows:
        groups.setdefault(keys(r), []).append(r[3])
    out = {}
    for k, amounts in groups.items():
        present = [a for a in amounts if a is not None]
        total = sum(present) if present else None
        avg = total / len(present) if present else None
        out[k] = (len(amounts), round2(total), round2(avg), min(present, default=None), max(present, default=None))
    return out


@SETTINGS
@given(st.lists(st.tuples(iso_dates, amounts_int, categories), min_size=1, max_size=30))
def test_summaries_match_brute_force(spark, rows):
    data = [(i, d, "x", a, c) for i, (d, a, c) in enumerate(rows)]
    df = with_date_parts(sales_from_rows(spark, data))
    by_cat = brute_summary(data, lambda r: r[4])
    for summary in (category_summary(df), category_summary_from_totals(monthly_totals(df))):
        got = {r.category: (r.total_sales, r.total_revenue, r.avg_amount, r.min_amount, r.max_amount) for r in summary.collect()}
        assert got == by_cat

    by_month = {k: v[:3] for k, v in brute_summary(data, lambda r: ("2024", r[1][5:7], r[4])).items()}
    for summary in (monthly_summary(df), monthly_summary_from_totals(monthly_totals(df))):
        got = {(r.year, r.month, r.category): (r.total_sales, r.total_revenue, r.avg_amount) for r in summary.collect()}
        assert got == by_month


def lenient_date(s):
    m = re.fullmatch(r"(\d{4})-(\d{1,2})-(\d{1,2})", s or "")
    if not m:
        return None
    try:
        return dt.date(int(m[1]), int(m[2]), int(m[3]))
    except ValueError:
        return None


@SETTINGS
@given(st.lists(dates, min_size=1, max_size=25))
def test_partition_values_match_brute_force(spark, raw_dates):
    from salesflow.operators import with_partition_values

    data = [(i, d, "p", 1.0, "c") for i, d in enumerate(raw_dates)]
    got = [(r.id, r.year, r.month) for r in with_partition_values(sales_from_rows(spark, data)).orderBy("id").collect()]
    want = []
    for i, d, *_ in data:
        parsed = lenient_date(d) if d not in ("2024-01-15 10:00:00",) else dt.date(2024, 1, 15)
        want.append((i, f"{parsed.year}" if parsed else None, f"{parsed.month:02d}" if parsed else None))
    assert got == want


batch = st.lists(
    st.tuples(st.integers(0, 10_000), st.sampled_from(["a", "b", "c", "d"]), st.sampled_from(["2023", "2024"])),
    min_size=1,
    max_size=12,
)


@settings(max_examples=int(os.environ.get("PROPERTY_EXAMPLES", "8")), derandomize=True, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batch, batch)
def test_overwrite_modes_match_model(spark, first, second):
    from salesflow.operators import insert_into, overwrite_partitions, save_table
    from salesflow.session import scratch_database

    schema = "id int, category string, year string"
    one, two = spark.createDataFrame(first, schema), spark.createDataFrame(second, schema)
    db = scratch_database(spark)

    def rows(table):
        return sorted(tuple(r) for r in spark.table(table).select("id", "category", "year").collect())

    save_table(one, f"{db}.dyn", partition_by=("category", "year"))
    overwrite_partitions(two, f"{db}.dyn")
    touched = {(c, y) for _, c, y in second}
    assert rows(f"{db}.dyn") == sorted([r for r in first if (r[1], r[2]) not in touched] + list(second))

    save_table(one, f"{db}.full", partition_by=("category", "year"))
    save_table(two, f"{db}.full", partition_by=("category", "year"))
    assert rows(f"{db}.full") == sorted(second)

    save_table(one, f"{db}.app", partition_by=("category", "year"))
    insert_into(two, f"{db}.app")
    assert rows(f"{db}.app") == sorted(list(first) + list(second))
