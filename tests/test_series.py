from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from conftest import in_order, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from gristmill.operators import series, slicing
from gristmill.sources import datasets

# The price rows of the fixture.
PRICES = """Timestamp,Stock,Price
2026-01-05,AAPL,185.00
2026-01-05,GOOGL,160.00
2026-01-05,MSFT,415.00
2026-01-05,AMZN,175.00
2026-01-05,TSLA,210.00
2026-01-06,AAPL,185.50
2026-01-06,GOOGL,159.90
2026-01-06,MSFT,416.20
2026-01-06,AMZN,177.05
2026-01-06,TSLA,208.50
2026-01-07,AAPL,184.20
2026-01-07,GOOGL,161.40
2026-01-07,MSFT,414.80
2026-01-07,AMZN,176.80
2026-01-07,TSLA,212.00
2026-01-08,AAPL,186.80
2026-01-08,GOOGL,163.50
2026-01-08,MSFT,418.50
2026-01-08,AMZN,178.90
2026-01-08,TSLA,206.40
2026-01-09,AAPL,188.10
2026-01-09,GOOGL,164.20
2026-01-09,MSFT,422.00
2026-01-09,AMZN,180.20
2026-01-09,TSLA,205.10
2026-01-12,AAPL,187.50
2026-01-12,GOOGL,162.80
2026-01-12,MSFT,420.50
2026-01-12,AMZN,182.40
2026-01-12,TSLA,209.80
2026-01-13,AAPL,189.90
2026-01-13,GOOGL,165.10
2026-01-13,MSFT,424.30
2026-01-13,AMZN,184.50
2026-01-13,TSLA,214.20
2026-01-14,AAPL,191.20
2026-01-14,GOOGL,164.70
2026-01-14,MSFT,423.80
2026-01-14,AMZN,186.10
2026-01-14,TSLA,218.60
2026-01-15,AAPL,190.40
2026-01-15,GOOGL,166.30
2026-01-15,MSFT,426.10
2026-01-15,AMZN,185.40
2026-01-15,TSLA,215.00
2026-01-16,AAPL,192.80
2026-01-16,GOOGL,168.00
2026-01-16,MSFT,429.50
2026-01-16,AMZN,188.70
2026-01-16,TSLA,222.40
2026-01-19,AAPL,194.10
2026-01-19,GOOGL,167.50
2026-01-19,MSFT,428.20
2026-01-19,AMZN,190.20
2026-01-19,TSLA,220.10
2026-01-20,AAPL,193.50
2026-01-20,GOOGL,169.80
2026-01-20,MSFT,431.00
2026-01-20,AMZN,192.50
2026-01-20,TSLA,226.50
2026-01-21,AAPL,196.20
2026-01-21,GOOGL,171.00
2026-01-21,MSFT,433.80
2026-01-21,AMZN,194.10
2026-01-21,TSLA,231.00
2026-01-22,AAPL,195.80
2026-01-22,GOOGL,170.40
2026-01-22,MSFT,432.50
2026-01-22,AMZN,193.80
2026-01-22,TSLA,228.40
2026-01-23,AAPL,198.50
2026-01-23,GOOGL,173.20
2026-01-23,MSFT,436.00
2026-01-23,AMZN,197.00
2026-01-23,TSLA,235.20
"""
# The report that these prices must give.
REPORT = [
    ("AMZN", 175.0, 197.0, 185.51, 175.0, 197.0, 12.57, 0.67),
    ("TSLA", 210.0, 235.2, 217.55, 205.1, 235.2, 12.0, 1.96),
    ("GOOGL", 160.0, 173.2, 165.85, 159.9, 173.2, 8.25, 0.78),
    ("AAPL", 185.0, 198.5, 190.63, 184.2, 198.5, 7.3, 0.76),
    ("MSFT", 415.0, 436.0, 424.81, 414.8, 436.0, 5.06, 0.51),
]
ORDER = ("day",)


@pytest.fixture(scope="module")
def stocks(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("prices") / "prices.csv"
    path.write_text(PRICES)
    return datasets.prices(spark, str(path)).withColumnRenamed("ts", "day")


@pytest.mark.parametrize("slice_rows", [1000, 10])
def test_performance(stocks, slice_rows):
    report = series.performance(stocks, order=ORDER, slice_rows=slice_rows)
    assert in_order(report) == REPORT
    assert series.best_performer(report).first()["stock"] == "AMZN"


def test_summary(stocks):
    assert in_order(series.summary(stocks).filter("stock = 'TSLA'")) == [("TSLA", 15, 217.55, 235.2, 205.1)]


def test_first_rows(stocks):
    frame = series.indicators(stocks, order=ORDER).filter("stock = 'AMZN'").orderBy("day")
    shown = in_order(frame.select("price", "previous_price", "daily_return", "moving_average").limit(3))
    assert shown == [(175.0, None, 0.0, 175.0), (177.05, 175.0, 1.17, 176.03), (176.8, 177.05, -0.14, 176.28)]


def test_zero_predecessor_gives_zero(spark):
    frame = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 5.0)], "stock STRING, day INT, price DOUBLE")
    assert {r["daily_return"] for r in series.with_previous(frame, order=ORDER).collect()} == {0.0}


def test_nulls_are_left_out(spark):
    ticks = [("a", 1, 1.0), (None, 2, 1.0), ("a", None, 1.0), ("a", 3, None)]
    frame = spark.createDataFrame(ticks, "stock STRING, day INT, price DOUBLE")
    assert series.clean(frame, order=ORDER).count() == 1


def _ticks(kind):
    """400 ticks, a third or more of them in one series, and in some cases at one moment."""
    rng = random.Random(7)
    start, out = datetime(2024, 1, 1), []
    for tick in range(400):
        stock = "hot" if rng.random() < 0.5 else rng.choice("abcdefgh")
        moment = start + timedelta(seconds=rng.randrange(10**6))
        if kind == "one moment" and rng.random() < 0.5 or kind == "all at once":
            moment = start + timedelta(seconds=500)
        if kind == "late burst" and rng.random() < 0.6:
            moment = start + timedelta(days=300, microseconds=rng.randrange(50))
        out.append((stock, moment, tick, round(rng.random() * 100, 2)))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("kind", ["even", "one moment", "all at once", "late burst"])
@pytest.mark.parametrize("slice_rows", [3, 40])
def test_slices_give_the_same_values_as_whole_series(spark, kind, slice_rows):
    frame = spark.createDataFrame(_ticks(kind), "stock STRING, ts TIMESTAMP_NTZ, tick LONG, price DOUBLE")
    whole = Window.partitionBy("stock").orderBy("ts", "tick")
    expected = frame.select(
        "stock", "tick",
        F.lag("price").over(whole),
        F.lead("price").over(whole),
        F.round(F.avg("price").over(whole.rowsBetween(-2, 0)), 2),
    )
    carried = slicing.sliced_series(frame, "stock", series.ORDER, 2, 1, slice_rows)
    window = slicing.window_by_slice("stock", series.ORDER)
    found = slicing.own_rows(
        carried.select(
            "stock", "tick",
            F.lag("price").over(window),
            F.lead("price").over(window),
            F.round(F.avg("price").over(window.rowsBetween(-2, 0)), 2),
            slicing.SLICE, slicing.CARRIED,
        )
    )
    assert rows(found) == rows(expected)


@pytest.mark.parametrize("kind", ["even", "one moment", "all at once", "late burst"])
def test_no_slice_holds_a_large_part(spark, kind):
    frame = spark.createDataFrame(_ticks(kind), "stock STRING, ts TIMESTAMP_NTZ, tick LONG, price DOUBLE")
    sliced = slicing.with_slices(frame, series.ORDER, 20)
    largest = sliced.groupBy(slicing.SLICE).count().agg(F.max("count")).first()[0]
    assert largest <= 3 * 400 / 20


def test_few_rows_are_one_slice(spark):
    ticks = spark.createDataFrame(_ticks("even"), "stock STRING, ts TIMESTAMP_NTZ, tick LONG, price DOUBLE")
    sliced = slicing.sliced_series(ticks, "stock", series.ORDER, 2, 0, 400)
    assert sliced.select(slicing.SLICE).distinct().count() == 1 and sliced.filter(slicing.CARRIED).count() == 0
    cut = slicing.sliced_series(ticks, "stock", series.ORDER, 2, 0, 60)
    assert cut.select(slicing.SLICE).distinct().count() > 4


@pytest.mark.parametrize("zone", ["America/New_York", "Europe/Berlin", "UTC"])
@pytest.mark.parametrize("kind", ["TIMESTAMP", "TIMESTAMP_NTZ", "DATE"])
def test_slices_where_the_clocks_change(spark, zone, kind):
    """A tick a minute over the nights in which clocks go back, in a session of that zone."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        seconds = F.expr("IF(id < 400, 1698530400, 1699149600) + id * 60")
        ticks = spark.range(800).select(
            F.expr("IF(id % 7 = 0, 'a', 'b')").alias("stock"), F.timestamp_seconds(seconds).cast(kind).alias("ts"),
            F.col("id").alias("tick"), F.expr("CAST(id * 37 % 101 AS DOUBLE)").alias("price"),
        )
        whole = Window.partitionBy("stock").orderBy("ts", "tick")
        expected = rows(ticks.select("stock", "tick", F.lag("price").over(whole)))
        found = series.with_previous(ticks, slice_rows=20).select("stock", "tick", "previous_price")
        assert rows(found) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_endpoints_on_every_row(stocks):
    frame = series.with_endpoints(stocks, order=ORDER)
    assert frame.count() == 75
    assert rows(frame.filter("stock = 'MSFT'").select("first_price", "last_price").distinct()) == [(415.0, 436.0)]


def test_next_value(stocks):
    frame = series.with_next(stocks, order=ORDER, slice_rows=10).filter("stock = 'AAPL'").orderBy("day")
    assert [r["next_price"] for r in frame.collect()] == [
        float(line.split(",")[2]) for line in PRICES.split() if ",AAPL," in line
    ][1:] + [None]
