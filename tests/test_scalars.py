import datetime as dt

import pytest
from pyspark.sql import functions as F

from rootlens.functions import scalars as sc


def value_of(spark, kind, value, expression):
    frame = spark.createDataFrame([(value,)], f"x {kind}")
    return frame.select(expression(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "value, text",
    [(1234.56, "1,234.56"), (1234567.89, "1,234,567.89"), (None, "0.00"), (-100.5, "100.50")],
)
def test_money_text(spark, value, text):
    assert value_of(spark, "double", value, sc.money_text) == text


@pytest.mark.parametrize(
    "value, digits, text",
    [(45.0, 2, "45.0"), (38.1, 2, "38.1"), (38.12, 2, "38.12"), (2.5e8, 1, "250000000.0"), (0.25, 1, "0.2")],
)
def test_number_text(spark, value, digits, text):
    assert value_of(spark, "double", value, lambda c: sc.number_text(c, digits)) == text


@pytest.mark.parametrize("value, text", [(-3.25, "-3.2"), (3.25, "+3.2"), (0.0, "+0.0"), (12.36, "+12.4")])
def test_signed_text(spark, value, text):
    assert value_of(spark, "double", value, sc.signed_text) == text


@pytest.mark.parametrize(
    "raw, metric, heading",
    [
        ("total_revenue", "Total Revenue", "Total_revenue"),
        ("unit_price2go", "Unit Price2Go", "Unit_price2go"),
        ("sub-category (all)", "Sub-Category (All)", "Sub-Category (All)"),
    ],
)
def test_titles(spark, raw, metric, heading):
    assert value_of(spark, "string", raw, sc.metric_title) == metric
    assert value_of(spark, "string", raw, sc.heading_text) == heading


NAMES = {
    "Order Priority": "order_priority",
    "Product Sub-Category": "product_sub_category",
    "  mrr_amount ": "mrr_amount",
    "2024 total": "_2024_total",
    "%%": "column",
    "Größe": "gr_e",
    "__x__": "x",
}


@pytest.mark.parametrize("raw, safe", NAMES.items())
def test_safe_names(spark, raw, safe):
    assert sc.safe_name(raw) == safe
    assert value_of(spark, "string", raw, sc.safe_name_column) == safe


def test_colliding_names_are_refused():
    with pytest.raises(ValueError, match="both become 'a_b'"):
        sc.safe_names(["a b", "A-B"])


@pytest.mark.parametrize(
    "text, day",
    [
        ("2024-03-09", (2024, 3, 9)),
        ("2024-03-09T10:11:12", (2024, 3, 9)),
        (" 2024-03-09 10:11:12.5 ", (2024, 3, 9)),
        ("3/9/2024", (2024, 3, 9)),
        ("2024/03/09", (2024, 3, 9)),
        ("Mar 9, 2024", (2024, 3, 9)),
        ("20240309", (2024, 3, 9)),
        ("31/12/2024", None),
        ("2024-13-01", None),
        ("12:30", None),
        ("n/a", None),
        ("", None),
        (None, None),
    ],
)
def test_lenient_dates(spark, text, day):
    found = value_of(spark, "string", text, lambda c: F.to_date(sc.lenient_timestamp(c)))
    assert found == (dt.date(*day) if day else None)


def test_day_difference_counts_midnights(spark):
    frame = spark.sql("SELECT TIMESTAMP'2024-01-01 23:59:00' a, TIMESTAMP'2024-01-02 00:01:00' b")
    assert frame.select(sc.days_between(F.col("a"), F.col("b"))).first()[0] == 1


def test_percent_handles_zero_and_rounds_half_even(spark):
    assert value_of(spark, "double", 0.0, lambda c: sc.percent(F.lit(1.0), c)) is None
    assert value_of(spark, "double", 0.0, lambda c: sc.percent_or_zero(F.lit(1.0), c)) == 0.0
    assert value_of(spark, "double", 0.125, sc.half_even) == 0.12
