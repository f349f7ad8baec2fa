from __future__ import annotations

import pytest
from conftest import in_order, rows
from pyspark.sql import functions as F

from gristmill.functions import numbers
from gristmill.operators import projections, ranking, sales
from gristmill.sources import files, schemas, tables

# The order lines of the fixture.
ORDERS = """OrderID,Product,Category,Quantity,Price,City
0001,Laptop,Electronics,2,55000,Ahmedabad
0002,Mobile,Electronics,5,25000,Surat
0003,Headphones,Electronics,10,2000,Vadodara
0004,TShirt,Clothing,8,800,Ahmedabad
0005,Jeans,Clothing,5,1500,Surat
0006,Sofa,Furniture,2,30000,Ahmedabad
0007,Chair,Furniture,6,5000,Rajkot
0008,Watch,Accessories,7,2500,Surat
0009,Shoes,Footwear,4,3000,Vadodara
0010,Laptop,Electronics,1,55000,Rajkot
0011,TShirt,Clothing,10,800,Surat
0012,Sofa,Furniture,1,30000,Vadodara
0013,Mobile,Electronics,3,25000,Ahmedabad
0014,Shoes,Footwear,6,3000,Surat
0015,Watch,Accessories,4,2500,Rajkot
"""


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("orders") / "orders.csv"
    path.write_text(ORDERS)
    frame = files.snake_case(files.read_csv(spark, str(path), schemas.ORDER_LINES))
    return projections.with_revenue(frame)


def test_leading_zeros_stay(orders):
    assert orders.orderBy("orderid").first()["orderid"] == "0001"


# The totals in the tests below are those that these order lines must give.
def test_category_revenue(orders):
    assert in_order(sales.total_by(orders, ["category"], "revenue", "total")) == [
        ("Electronics", 385000.0), ("Furniture", 120000.0), ("Footwear", 30000.0),
        ("Accessories", 27500.0), ("Clothing", 21900.0),
    ]


def test_product_quantities_break_ties_by_name(orders):
    assert in_order(sales.total_by(orders, ["product"], "quantity", "sold")) == [
        ("TShirt", 18.0), ("Watch", 11.0), ("Headphones", 10.0), ("Shoes", 10.0), ("Mobile", 8.0),
        ("Chair", 6.0), ("Jeans", 5.0), ("Laptop", 3.0), ("Sofa", 3.0),
    ]


def test_city_revenue_and_top_three(orders):
    cities = [("Ahmedabad", 251400.0), ("Surat", 176000.0), ("Rajkot", 95000.0), ("Vadodara", 62000.0)]
    assert in_order(sales.total_by(orders, ["city"], "revenue", "total")) == cities
    assert in_order(sales.top_totals(orders, ["city"], "revenue", "total", 3)) == cities[:3]


def test_average_revenue(orders):
    assert sales.average_of(orders, "revenue", "average").first()["average"] == 38960.0


def test_net_revenue_by_category_from_the_least(orders):
    net = projections.with_net_revenue(orders)
    assert in_order(sales.total_by(net, ["category"], "final_revenue", "total", ascending=True)) == [
        ("Clothing", 19710.0), ("Accessories", 24750.0), ("Footwear", 27000.0),
        ("Furniture", 108000.0), ("Electronics", 346500.0),
    ]


def test_share_of_total(orders):
    totals = sales.total_by(orders, ["category"], "revenue", "total")
    shares = dict(rows(ranking.share_of_total(totals, "total").select("category", "share_pct")))
    assert shares["Electronics"] == 65.88


def test_totals_are_exact(spark):
    """Also where adding doubles is not, and for amounts below zero."""
    frame = spark.createDataFrame([(0.1,)] * 1000 + [(-1e11,), (1e11,), (-0.0001,), (None,), (float("nan"),)], "x DOUBLE")
    assert str(frame.agg(numbers.total(frame, "x")).first()[0]) == "99.9999"
    assert frame.filter("false").agg(numbers.total(frame, "x")).first()[0] is None
    fine = spark.range(1000).select(F.lit(0.00004).alias("x"))
    assert float(fine.agg(numbers.total(fine, "x", 5)).first()[0]) == 0.04
    with pytest.raises(Exception, match="more than 4 decimals"):
        fine.agg(numbers.total(fine, "x")).collect()


def test_revenue_does_not_overflow(spark):
    big = spark.createDataFrame([(2_000_000_000, 2_000_000_000)], "quantity INT, price INT")
    assert projections.with_revenue(big).first()["revenue"] == 4 * 10**18


FLAT = (
    "order_id STRING, customer_id STRING, customer_name STRING, segment STRING, region STRING, state STRING, "
    "category STRING, sub_category STRING, product STRING, order_date DATE, sales DECIMAL(18,4), "
    "profit DECIMAL(18,4), quantity LONG, discount DOUBLE, lines LONG"
)


@pytest.fixture(scope="module")
def flat(spark):
    from datetime import date
    from decimal import Decimal as D

    return spark.createDataFrame(
        [
            ("o1", "c1", "Ann Lee", "Home", "East", "NY", "Tech", "Phones", "Phone", date(2021, 1, 5), D(100), D(-5), 2, 0.1, 1),
            ("o1", "c1", "Ann Lee", "Home", "East", "NY", "Tech", "Cases", "Case", date(2021, 1, 5), D(50), D(20), 1, 0.0, 1),
            ("o2", "c2", "Bo (x)", "Work", "West", "CA", "Tech", "Phones", "Phone", date(2022, 4, 1), D(100), D(1), 1, 0.3, 1),
            ("o3", "c2", "Bo (x)", "Work", "West", "CA", "Desk", None, None, date(2022, 12, 31), D(0), D(0), 4, 0.0, 1),
        ],
        FLAT,
    )


def test_kpis(flat):
    kpis = sales.kpi_row(flat).first().asDict()
    assert kpis == {
        "total_sales": 250.0, "total_profit": 16.0, "distinct_orders": 3, "distinct_customers": 2,
        "total_quantity": 8, "avg_order_value": 250 / 3, "profit_margin_pct": 6.4,
    }


@pytest.mark.parametrize("grain", [sales.ORDER, sales.CUSTOMER])
def test_rows_added_up_before_give_the_same(flat, grain):
    keys = ["customer_id", "customer_name", "segment", "region"]
    measures = [numbers.total(flat, m).alias(m) for m in ("sales", "profit", "quantity", "lines")]
    if grain == sales.ORDER:
        added = flat.groupBy("order_id", *keys).agg(*measures)
    else:
        added = flat.groupBy(*keys).agg(*measures, F.countDistinct("order_id").alias("orders"))
    assert rows(sales.kpi_row(added, grain)) == rows(sales.kpi_row(flat))
    assert rows(sales.segment_summary(added, grain)) == rows(sales.segment_summary(flat))
    assert rows(sales.summary(added, ["region"], grain)) == rows(sales.summary(flat, ["region"]))
    assert rows(sales.customer_leaderboard(added, grain=grain)) == rows(sales.customer_leaderboard(flat))


def test_kpis_as_text(flat):
    assert dict(rows(sales.kpi_long(sales.kpi_row(flat)))) == {
        "Total Sales ($)": "$250.00", "Total Profit ($)": "$16.00", "Distinct Orders (#)": "3",
        "Distinct Customers (#)": "2", "Total Quantity Sold (#)": "8", "Average Order Value ($)": "$83.33",
        "Overall Profit Margin (%)": "6.40%",
    }


def test_kpis_of_nothing(flat):
    kpis = sales.kpi_row(flat.filter("false")).first()
    assert (kpis["total_sales"], kpis["distinct_orders"], kpis["avg_order_value"], kpis["profit_margin_pct"]) == (0, 0, 0, 0)


def test_summary_leaves_out_missing_keys_and_empty_sales(flat):
    assert rows(sales.summary(flat, ["category", "sub_category"])) == [
        ("Tech", "Cases", 50.0, 20.0, 1, 1, 40.0),
        ("Tech", "Phones", 200.0, -4.0, 3, 2, -2.0),
    ]
    assert rows(sales.summary(flat, ["category"]))[0] == ("Desk", 0.0, 0.0, 4, 1, 0.0)


def test_margin_rounds_half_to_even(spark):
    halves = spark.createDataFrame([(1.0, 800.0), (3.0, 800.0)], "part DOUBLE, whole DOUBLE")
    assert sorted(r[0] for r in halves.select(numbers.percent(F.col("part"), F.col("whole"))).collect()) == [0.12, 0.38]


def test_loss_leaders_need_no_high_discount(flat):
    assert in_order(sales.loss_leaders(flat).select("product", "total_profit", "avg_discount")) == [
        ("Phone", -4.0, pytest.approx(0.2))
    ]


def test_top_products_are_shown_ascending(flat):
    assert [r[0] for r in in_order(sales.top_products(flat.dropna(), "sales", 2))] == ["Case", "Phone"]


def test_segments_and_customers(flat):
    assert rows(sales.segment_summary(flat)) == [("Home", 150.0, 15.0, 1, 1, 150.0), ("Work", 100.0, 1.0, 1, 2, 50.0)]
    best = in_order(sales.customer_leaderboard(flat, 1))
    assert best == [("c1", "Ann Lee", "Home", 150.0, 15.0, 1, 75.0)]


def test_trends(flat):
    assert in_order(sales.monthly_trend(flat)) == [
        ("2021-01", 150.0, 15.0), ("2022-04", 100.0, 1.0), ("2022-12", 0.0, 0.0)
    ]
    assert [r[0] for r in in_order(sales.quarter_totals(flat))] == ["2021Q1", "2022Q2", "2022Q4"]
    assert in_order(sales.monthly_totals(flat, "sales", "total", merge_years=True)) == [(1, 150.0), (4, 100.0), (12, 0.0)]


def test_facets(flat):
    assert projections.facet_filter(flat).count() == 4
    assert projections.facet_filter(flat, years=[]).count() == 4
    assert projections.facet_filter(flat, region="West", years=[2022]).count() == 2
    assert projections.facet_filter(flat, category="Tech", segment="Home").count() == 2


def test_search(flat):
    columns = ("customer_name", "product", "order_id")
    assert projections.search(flat, "", columns).count() == 4
    assert projections.search(flat, "ANN|case", columns).count() == 2
    assert projections.search(flat, "(x)", columns, literal=True).count() == 2
    assert projections.search(flat, "nothing", columns).count() == 0


def test_calendar(spark):
    days = spark.sql("SELECT DATE'2021-04-05' AS order_date, DATE'2021-04-01' AS ship_date")
    row = projections.with_calendar(days).first()
    assert tuple(row)[2:] == (2021, "2021Q2", "2021-04", "Apr", "Monday", -4)


def test_previews_are_right_aligned(orders):
    from gristmill import sinks

    lines = sinks.preview_lines(sales.total_by(orders, ["category"], "revenue", "total"), 2)
    assert lines == [
        "+-----------+--------+",
        "|   category|   total|",
        "+-----------+--------+",
        "|Electronics|385000.0|",
        "|  Furniture|120000.0|",
        "+-----------+--------+",
    ]


def test_lines_are_shuffled_once_for_order_and_customer(spark, sf_dir):
    """Customers join the orders, not the lines: the last join of the lines is that with the orders."""
    lines = tables.sales_lines(spark, sf_dir, "order_id", "customer_name", "state")
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert "order_id" in joins[0] and sum("customer_id" in line for line in joins) == 1
