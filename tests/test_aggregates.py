"""Aggregate semantics: NULL handling, count(id) vs count(*), roll-up equality."""

from salesflow.operators import (
    category_summary,
    category_summary_from_totals,
    monthly_summary,
    monthly_summary_from_totals,
    monthly_totals,
    partition_revenue,
    row_count,
    sales_aggregate,
    with_date_parts,
)
from salesflow.sources import sales_from_rows

ROWS = [
    (1, "2024-01-15", "a", 10.0, "x"),
    (None, "2024-01-16", "b", None, "x"),
    (3, "2024-02-01", "c", 2.5, None),
    (4, "2024-02-01", "d", None, "y"),
]


def test_count_id_skips_null_ids(spark):
    df = with_date_parts(sales_from_rows(spark, ROWS))
    got = {(r.category, r.month): (r.total_sales, r.total_amount, r.avg_amount) for r in sales_aggregate(df).collect()}
    assert got[("x", "01")] == (1, 10.0, 10.0)
    assert got[(None, "02")] == (1, 2.5, 2.5)
    assert got[("y", "02")] == (1, None, None)
    g1 = {(r.category, r.month): (r.cnt, r.revenue) for r in partition_revenue(df).collect()}
    assert g1[("x", "01")] == (2, 10.0)


def test_summaries_from_totals_equal_direct(spark):
    df = with_date_parts(sales_from_rows(spark, ROWS))
    totals = monthly_totals(df)
    assert sorted(map(tuple, category_summary(df).collect()), key=str) == sorted(
        map(tuple, category_summary_from_totals(totals).collect()), key=str
    )
    assert sorted(map(tuple, monthly_summary(df).collect()), key=str) == sorted(
        map(tuple, monthly_summary_from_totals(totals).collect()), key=str
    )


def test_row_count(spark):
    assert row_count(sales_from_rows(spark, ROWS)).first().row_count == 4
