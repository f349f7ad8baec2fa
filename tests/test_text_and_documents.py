from __future__ import annotations

import pytest
from conftest import in_order, rows
from pyspark.sql import functions as F

from gristmill import sinks
from gristmill.functions import text
from gristmill.operators import documents, weather, wordcount
from gristmill.sources import files, schemas


def test_word_count(spark):
    lines = spark.createDataFrame([("data  is data",), ("the Data\tof",), ("",)], "value STRING")
    assert dict(rows(wordcount.word_count(lines))) == {"data": 3, "is": 1, "the": 1, "of": 1}
    assert in_order(wordcount.top_words(lines)) == [("data", 3)]


def test_tokens_drop_empty_pieces(spark):
    frame = spark.createDataFrame([("..Win £5,000 now!",)], "t STRING")
    assert frame.select(text.tokens(F.col("t"))).first()[0] == ["win", "5", "000", "now"]


def station_line(year, temperature, quality="1"):
    return f"{'0' * 15}{year}{'0' * 68}{temperature}{quality}"


def test_weather(spark, tmp_path):
    temperatures = ["+0035", "+0038", "+0036", "+0040", "+9999"]
    lines = [station_line(2020, t) for t in temperatures] + [station_line(2021, "-0011", "9"), "short", station_line("x?y!", "+0001")]
    (tmp_path / "weather.txt").write_text("\n".join(lines))
    readings = weather.readings(files.read_lines(spark, str(tmp_path / "weather.txt")))
    assert rows(weather.yearly(readings)) == [(2020, 40, 35, 37.25), (2021, -11, -11, -11.0)]
    only = weather.readings(files.read_lines(spark, str(tmp_path)), accepted_quality=["1"])
    assert rows(only.select("year").distinct()) == [(2020,)]


def test_key_values_round_trip(spark, tmp_path):
    frame = spark.createDataFrame([(2020, 35), (2021, 40)], "year INT, temperature INT")
    sinks.write_key_values(frame, str(tmp_path / "kv"))
    text_lines = {r[0] for r in files.read_lines(spark, str(tmp_path / "kv")).collect()}
    assert text_lines == {"2020\t35", "2021\t40"}
    assert rows(files.read_key_values(spark, str(tmp_path / "kv"), schemas.YEAR_READINGS)) == rows(frame)


# The order documents of the fixture.
ORDERS = """{"order_id": "1001", "customer": "Asha Rao", "category": "Electronics", "product": "Laptop", "quantity": 2, "price": 55000, "city": "Ahmedabad", "status": "Completed"}
{"order_id": "1002", "category": "Electronics", "product": "Mobile", "quantity": 5, "price": 25000, "city": "Surat", "status": "Completed"}
{"order_id": "1003", "category": "Clothing", "product": "TShirt", "quantity": 8, "price": 800, "city": "Ahmedabad", "status": "Completed"}
"""


def measures():
    return {
        "total_revenue": F.sum(F.col("quantity") * F.col("price")),
        "avg_price": F.avg("price"),
        "total_orders": F.count(F.lit(1)),
    }


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("documents") / "orders.json"
    path.write_text(ORDERS)
    return files.read_documents(spark, str(path), schemas.ORDER_DOCUMENTS).withColumn("_id", F.col("order_id"))


def by_category(frame):
    return in_order(
        documents.aggregate(
            frame, ["category"], measures(), match=F.col("status") == "Completed", sort=[F.desc("total_revenue")]
        )
    )


def test_missing_fields_are_null(orders):
    assert rows(orders.select("order_id", "customer")) == [("1001", "Asha Rao"), ("1002", None), ("1003", None)]


def test_aggregate(orders):
    assert by_category(orders) == [("Electronics", 235000, 40000.0, 2), ("Clothing", 6400, 800.0, 1)]


def test_update_then_delete_then_aggregate(orders):
    changed = documents.set_fields(orders, F.col("order_id") == "1001", {"status": "Delivered"}, one=True)
    left = documents.delete(changed, F.col("order_id") == "1003", one=True)
    assert by_category(left) == [("Electronics", 125000, 25000.0, 1)]


def test_find(orders):
    dear = documents.find(orders, F.col("price") > 20000, fields=("product",), sort=[F.desc("price")])
    assert in_order(dear) == [("Laptop",), ("Mobile",)]
    assert in_order(documents.find(orders, fields=("product",), limit=1)) == [("Laptop",)]
    chosen = documents.find(orders, F.col("category").isin("Clothing", "Shoes"))
    assert chosen.count() == 1


def test_unknown_conditions_keep_the_document(orders):
    assert documents.delete(orders, F.col("customer") == "Asha Rao").count() == 2
    changed = documents.set_fields(orders, F.col("customer") != "x", {"vip": True})
    assert rows(changed.select("order_id", "vip")) == [("1001", True), ("1002", None), ("1003", None)]


def test_one_and_many(orders):
    everywhere = F.col("status") == "Completed"
    assert documents.delete(orders, everywhere, one=True).count() == 2
    assert documents.delete(orders, everywhere).count() == 0
    assert documents.delete(orders, F.lit(False), one=True).count() == 3
    more = documents.increment(orders, everywhere, {"quantity": 2}, one=True)
    assert rows(more.select("order_id", "quantity")) == [("1001", 4), ("1002", 5), ("1003", 8)]


def test_increment_of_a_missing_number(orders):
    without = orders.withColumn("price", F.when(F.col("order_id") == "1001", F.col("price")))
    assert rows(documents.increment(without, F.lit(True), {"price": 1}).select("price")) == [(1,), (1,), (55001,)]


def test_insert(spark, orders):
    new = spark.createDataFrame([("9", "Home", 5)], "_id STRING, segment STRING, price INT")
    both = documents.insert(orders, new)
    assert both.count() == 4 and "segment" in both.columns
    assert both.filter("segment IS NULL").count() == 3


def test_snapshots_do_not_replace_each_other(spark, orders):
    first = sinks.write_snapshot(orders)
    second = sinks.write_snapshot(documents.delete(spark.read.parquet(first), F.col("order_id") == "1003"))
    assert (spark.read.parquet(first).count(), spark.read.parquet(second).count()) == (3, 2)
