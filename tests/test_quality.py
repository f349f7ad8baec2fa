from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from gristmill.operators import projections, quality

SALE = "id INT, order_date STRING, ship_date STRING, sales DOUBLE, quantity INT, discount DOUBLE, profit DOUBLE"
NAN = float("nan")
SALES = [
    (1, "2021-01-05", "2021-01-08", 10.0, 1, 0.1, 1.0),
    (1, "2021-01-05", "2021-01-08", 10.0, 1, 0.1, 1.0),  # a copy
    (2, "not a date", "2021-01-08", 10.0, 1, 0.1, 1.0),
    (3, "2021-01-05", "2021-01-08", 0.0, 1, 0.1, 1.0),
    (4, "2021-01-05", "2021-01-08", 10.0, -1, 0.1, 1.0),
    (5, "2021-01-05", "2021-01-04", 10.0, 1, 1.5, 1.0),  # discount above 1: counted, kept
    (6, "2021-01-05", "2021-01-08", 10.0, 1, 0.1, -4.0),  # a loss: kept
    (7, "2021-01-05", "2021-01-08", NAN, 1, 0.1, 1.0),
    (8, "2021-01-05", "2021-01-08", 10.0, 1, -0.1, 1.0),
]


def sales(spark):
    return spark.createDataFrame(SALES, SALE)


def test_clean_pass(spark):
    cleaned = quality.clean_sales(sales(spark))
    assert rows(cleaned.select("id", "shipping_days", "quarter")) == [(1, 3, "2021Q1"), (5, -1, "2021Q1"), (6, 3, "2021Q1")]
    assert rows(quality.clean_sales(sales(spark), drop_high_discount=True).select("id")) == [(1,), (6,)]


def test_report_agrees_with_the_cleaned_table(spark):
    report = dict(rows(quality.cleaning_report(sales(spark))))
    assert report == {
        "rows_in": 9, "duplicate_rows": 1, "invalid_order_dates": 1, "invalid_ship_dates": 0,
        "non_positive_sales": 1, "non_positive_quantity": 1, "invalid_discount": 2, "negative_profit": 1,
        "rows_out": 3, "rows_dropped": 6,
    }
    assert report["rows_out"] == quality.clean_sales(sales(spark)).count()


def test_null_counts_know_nan_and_text(spark):
    frame = spark.createDataFrame([("a", NAN, 1), (None, None, None)], "`Order ID` STRING, x DOUBLE, n INT")
    assert rows(quality.null_counts(frame)) == [("Order ID", 1), ("n", 1), ("x", 2)]


def test_duplicates(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, "a")], "k INT, v STRING")
    assert tuple(quality.duplicate_keys(frame, ["k"]).first()) == (5, 2, 3)
    assert tuple(quality.duplicate_rows(frame).first()) == (5, 3, 2)
    assert tuple(quality.duplicate_rows(frame.filter("false")).first()) == (0, 0, 0)


def test_negative_and_missing(spark):
    frame = spark.createDataFrame([(1, -1.0), (-1, 2.0), (3, NAN), (4, 1.0), (None, 1.0)], "a INT, b DOUBLE")
    assert rows(quality.negative_counts(frame, ["a", "b"])) == [("a", 1), ("b", 1)]
    assert rows(quality.drop_missing_and_negative(frame, ["a", "b"])) == [(4, 1.0)]


def test_dates_and_ranges(spark):
    assert dict(rows(quality.unreadable_dates(sales(spark), ["order_date", "ship_date"]))) == {"order_date": 1, "ship_date": 0}
    assert dict(rows(quality.range_checks(sales(spark)))) == {
        "non_positive_sales": 1, "non_positive_quantity": 1, "invalid_discount": 2
    }
    assert tuple(quality.negative_profit(sales(spark)).first()) == (1, 9, 11.1)


def test_messages(spark):
    raw = [(" Spam ", "win"), ("HAM", "hi"), ("other", "x"), ("ham", "  "), (None, "y"), ("ham", None)]
    cleaned = quality.clean_messages(spark.createDataFrame(raw, "label STRING, message_text STRING"))
    assert rows(cleaned) == [("ham", "hi"), ("spam", "win")]
    assert rows(quality.class_balance(cleaned)) == [("ham", 1), ("spam", 1)]


def test_schema_report(spark):
    report = quality.schema_report(spark, spark.createDataFrame([(1, "a")], "n INT, s STRING"))
    assert rows(report) == [(0, "n", "int", True), (1, "s", "string", True)]


def test_categorise_takes_the_first_match(spark):
    frame = spark.createDataFrame([("#A",), ("#B",), ("#C",)], "hashtag STRING")
    found = projections.categorise(frame, {"one": ["#A"], "two": ["#A", "#B"]})
    assert rows(found.select("category")) == [("Other",), ("one",), ("two",)]


def test_small_filters(spark):
    frame = spark.createDataFrame([("Laptop",), ("a laptop bag",), (None,), ("x",), (" ",)], "value STRING")
    assert projections.grep(frame, "LAPTOP").count() == 2
    assert projections.keep_values(frame, "value", ["x"]).count() == 1
    assert projections.not_blank(frame, "value").count() == 3
    assert [r[0] for r in projections.distinct_values(frame.filter(F.col("value").isNotNull()), "value").collect()] == [
        " ", "Laptop", "a laptop bag", "x"
    ]
