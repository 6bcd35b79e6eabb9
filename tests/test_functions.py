"""Scalar functions and transforms on edge rows."""

import datetime as dt

from pyspark.sql import functions as F

from salesflow.functions import month_text, parse_date, parse_sale_date, price_band, round_money, title_case, year_text
from salesflow.operators import clean_sales, with_date_parts
from salesflow.sources import sales_from_rows


def test_title_case(spark):
    df = spark.createDataFrame([("blue t-shirt XL",), ("PHONE",), (None,)], "s string")
    got = [r[0] for r in df.select(title_case("s")).collect()]
    assert got == ["Blue T-shirt Xl", "Phone", None]


def test_strict_and_lenient_dates(spark):
    df = spark.createDataFrame([("2024-1-5",), ("2024-01-15 10:00:00",), ("garbage",), ("2024-01-15",)], "s string")
    strict = [r[0] for r in df.select(parse_sale_date("s")).collect()]
    lenient = [r[0] for r in df.select(parse_date("s")).collect()]
    assert strict == [None, None, None, dt.date(2024, 1, 15)]
    assert lenient == [dt.date(2024, 1, 5), dt.date(2024, 1, 15), None, dt.date(2024, 1, 15)]


def test_date_parts_text(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5),), (dt.date(2023, 12, 31),), (None,)], "d date")
    got = [tuple(r) for r in df.select(year_text("d"), month_text("d")).collect()]
    assert got == [("2024", "01"), ("2023", "12"), (None, None)]


def test_lpad_truncates(spark):
    assert spark.range(1).select(F.lpad(F.lit("123"), 2, "0")).first()[0] == "12"


def test_price_band_edges_and_null(spark):
    df = spark.createDataFrame([(1000.0,), (300.0,), (299.99,), (999.995,), (None,)], "a double")
    got = [r[0] for r in df.select(price_band("a")).collect()]
    assert got == ["premium", "mid", "budget", "mid", "budget"]


def test_round_half_up_on_decimal_text(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-0.125,), (999.995,)], "a double")
    got = [r[0] for r in df.select(round_money("a")).collect()]
    assert got == [1.01, 2.68, -0.13, 1000.0]


def test_clean_sales_band_before_rounding(spark):
    df = sales_from_rows(spark, [(1, "2024-01-01", "x", 999.995, "c"), (2, "bad", None, None, "c")])
    rows = clean_sales(df).collect()
    assert (rows[0].amount, rows[0].price_category) == (1000.0, "mid")
    assert (rows[1].sale_date, rows[1].product, rows[1].amount, rows[1].price_category) == (None, None, None, "budget")
    assert clean_sales(df).columns == ["id", "sale_date", "product", "amount", "category", "price_category"]


def test_with_date_parts_columns(fixture_b):
    out = with_date_parts(fixture_b)
    assert out.columns == ["id", "sale_date", "product", "amount", "category", "year", "month"]
    assert dict(out.dtypes)["sale_date"] == "date"
    assert {(r.year, r.month) for r in out.collect()} == {("2023", "02"), ("2023", "12")}
