"""From CSV files to reports, as a user would run them."""

from __future__ import annotations

import pytest
from conftest import in_order, rows
from gristmill import sinks
from gristmill.operators import classify, projections, quality, ranking, sales, segments, series, storage, trends
from gristmill.sources import datasets, files

RETAIL = """Order ID,Order Date,Ship Date,Customer ID,Customer Name,Segment,Country,City,State,Postal Code,Region,Product ID,Category,Sub-Category,Product Name,Sales,Quantity,Discount,Profit
O-1,2021-01-04,2021-01-07,C1,Ann Lee,Consumer,US,Boston,MA,2101,East,P1,Furniture,Tables,Oak Table,100.50,1,0.4,-20.25
O-1,2021-01-04,2021-01-07,C1,Ann Lee,Consumer,US,Boston,MA,2101,East,P2,Technology,Phones,Phone X,200.25,2,0.0,50.00
O-1,2021-01-04,2021-01-07,C1,Ann Lee,Consumer,US,Boston,MA,2101,East,P2,Technology,Phones,Phone X,200.25,2,0.0,50.00
O-2,2021-05-31,2021-06-02,C2,Bo Chu,Corporate,US,Austin,TX,73301,Central,P1,Furniture,Tables,Oak Table,99.50,1,0.2,5.25
O-3,soon,2021-06-02,C2,Bo Chu,Corporate,US,Austin,TX,73301,Central,P1,Furniture,Tables,Oak Table,99.50,1,0.2,5.25
O-4,2022-02-01,2022-02-03,C2,Bo Chu,Corporate,US,Austin,TX,73301,Central,P2,Technology,Phones,Phone X,,1,0.0,5.00
O-5,2022-02-01,2022-02-03,C3,Cy Day,Home Office,US,Reno,NV,89501,West,P2,Technology,Phones,Phone X,50.00,1,0.0,10.00
"""


@pytest.fixture(scope="module")
def retail(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("retail") / "raw.csv"
    path.write_text(RETAIL)
    return datasets.retail_orders(spark, str(path.parent / "cleaned.csv"), str(path))


def test_retail_reports(spark, retail, tmp_path):
    cleaned = quality.clean_sales(retail)
    assert dict(rows(quality.cleaning_report(retail)))["rows_out"] == cleaned.count() == 4
    kpis = sales.kpi_row(cleaned).first()
    assert (kpis["total_sales"], kpis["total_profit"], kpis["distinct_orders"], kpis["distinct_customers"]) == (450.25, 45.0, 3, 3)
    assert rows(sales.summary(cleaned, ["category", "sub_category"])) == [
        ("Furniture", "Tables", 200.0, -15.0, 2, 2, -7.5),
        ("Technology", "Phones", 250.25, 60.0, 3, 2, 23.98),
    ]
    assert in_order(sales.monthly_trend(cleaned))[0] == ("2021-01", 300.75, 29.75)
    assert [r["product"] for r in sales.loss_leaders(cleaned).collect()] == ["Oak Table"]
    leaders = sales.customer_leaderboard(cleaned, 1)
    assert in_order(leaders) == [("C1", "Ann Lee", "Consumer", 300.75, 29.75, 1, 150.375)]
    found = projections.search(cleaned, "boston|phone", ("customer_name", "product", "order_id", "city"))
    assert found.count() == 3
    sinks.write_reports({"kpis": sales.kpi_long(sales.kpi_row(cleaned)), "monthly": sales.monthly_trend(cleaned)}, str(tmp_path))
    shown = dict(rows(files.read_csv(spark, str(tmp_path / "kpis"), "metric STRING, value STRING")))
    assert shown["Total Sales ($)"] == "$450.25" and shown["Overall Profit Margin (%)"] == "9.99%"


def test_cleaned_table_is_preferred(spark, retail, tmp_path):
    cleaned = str(tmp_path / "cleaned")
    original = retail.withColumnRenamed("product", "product_name").filter("order_id = 'O-5'")
    sinks.write_table(original, cleaned, kind="csv")
    (tmp_path / "raw.csv").write_text(RETAIL)
    assert datasets.retail_orders(spark, cleaned, str(tmp_path / "raw.csv")).count() == 1


def _csv(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


def test_order_lines_and_ratings(spark, tmp_path):
    orders = datasets.order_lines(spark, _csv(tmp_path, "o.csv", "OrderID,Product,Category,Quantity,Price,City\n0007,Pen,Desk,3,2,Bonn\n"))
    assert tuple(projections.with_revenue(orders).first()) == ("0007", "Pen", "Desk", 3, 2, "Bonn", 6)
    rated = datasets.ratings(spark, _csv(tmp_path, "r.csv", "userId,movieId,rating\n1,5,4.0\n2,5,1.0\n1,6,5.0\n"))
    assert in_order(storage.well_rated(rated)) == [(6, 5.0, 1)]


def test_prices(spark, tmp_path):
    text = "Timestamp,Stock,Price\n2026-01-06,A,11\n2026-01-05,A,10\n2026-01-05,B,7\n,B,8\n"
    ticks = series.clean(datasets.prices(spark, _csv(tmp_path, "p.csv", text)), order=("ts",))
    report = series.performance(ticks, order=("ts",))
    assert [(r["stock"], r["cumulative_return"]) for r in report.collect()] == [("A", 10.0), ("B", 0.0)]


def test_posts(spark, tmp_path):
    text = 'Hashtag,Date,Region,Platform\n#ai,2026-09-01,North,X\n"  #AI ",2026-09-01,North,Y\n,2026-09-01,South,X\nart,2026-09-02,South,X\n'
    posts = trends.clean_posts(datasets.posts(spark, _csv(tmp_path, "t.csv", text)))
    assert rows(trends.tag_frequency(posts)) == [("#AI", 2), ("#ART", 1)]
    assert [r["hashtag"] for r in trends.daily_leaders(posts).orderBy("day").collect()] == ["#AI", "#ART"]
    assert rows(trends.group_leaders(posts, "platform").select("platform", "hashtag", "rank")) == [
        ("X", "#AI", 1), ("X", "#ART", 1), ("Y", "#AI", 1)
    ]
    assert in_order(ranking.most_frequent(trends.tag_frequency(posts), 1, "hashtag")) == [("#AI", 2)]


def test_customers_and_messages(spark, tmp_path):
    header = "customer_id,total_spend,purchase_count,avg_basket_size,days_since_last_purchase,product_category_preference\n"
    lines = "".join(f"C{i},{100 + i * 900 * (i % 2)},{1 + i},{50 + i},{200 - i},1\n" for i in range(8)) + "C9,-1,1,1,1,2\nC10,5,,1,1,2\n"
    frame = datasets.customers(spark, _csv(tmp_path, "c.csv", header + lines))
    valid = quality.drop_missing_and_negative(frame, segments.FEATURES)
    assert valid.count() == 8
    assert segments.scaled(valid).select(*segments.as_columns("scaled_features", segments.FEATURES)).count() == 8
    text = 'label,message_text\nSPAM ,"win, now"\nham,hello\nother,x\nham,\n'
    cleaned = quality.clean_messages(datasets.messages(spark, _csv(tmp_path, "m.csv", text)))
    assert rows(classify.with_label(cleaned)) == [("ham", "hello", 0.0), ("spam", "win, now", 1.0)]
