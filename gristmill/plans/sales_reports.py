"""Sales, ratings and retail reports with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions import dates
from gristmill.operators import distinct, projections, reporting, sales, search_index, storage
from gristmill.plans.registry import Register
from gristmill.plans.sqltext import SALES, double, long, percent, ratio
from gristmill.session import written
from gristmill.sources import tables

query = Register()


def _total(key: str, measure: str, name: str, tail: str = "") -> str:
    return f"WITH {SALES} SELECT {key}, {double(f'sum({measure})')} AS {name} FROM sales GROUP BY {key} {tail}"


@query("revenue_by_category", _total("category", "sales", "total_revenue"))
def revenue_by_category(spark, sf_dir):
    return sales.total_by(tables.part_totals(spark, sf_dir, "category", "sales"), ["category"], "sales", "total_revenue")


@query(
    "top_products",
    f"WITH {SALES} SELECT product, {long('sum(quantity)')} AS total_quantity FROM sales GROUP BY product",
)
def top_products(spark, sf_dir):
    totals = tables.part_totals(spark, sf_dir, "product", "quantity").groupBy("product")
    return totals.agg(F.sum("quantity").alias("total_quantity")).orderBy(F.desc("total_quantity"), "product")


@query("city_revenue", _total("state", "sales", "total_revenue"))
def city_revenue(spark, sf_dir):
    return sales.total_by(tables.customer_totals(spark, sf_dir, "state", "sales"), ["state"], "sales", "total_revenue")


@query("city_revenue_top3", _total("state", "sales", "total_revenue", "ORDER BY total_revenue DESC, state LIMIT 3"))
def city_revenue_top3(spark, sf_dir):
    return sales.top_totals(
        tables.customer_totals(spark, sf_dir, "state", "sales"), ["state"], "sales", "total_revenue", 3
    )


@query(
    "avg_order_revenue",
    f"""WITH {SALES}, per_order AS (SELECT order_id, sum(sales) AS sales FROM sales GROUP BY order_id)
        SELECT {ratio('sum(sales)', 'count(sales)')} AS avg_order_revenue FROM per_order""",
)
def avg_order_revenue(spark, sf_dir):
    return sales.average_of(tables.order_totals(spark, sf_dir, "order_id", "sales"), "sales", "avg_order_revenue")


def _priced_lines(spark, sf_dir, *columns):
    """Order lines with the catalogue price of the part in cents."""
    parts = tables.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part_id"),
        F.col("p_type").alias("category"),
        (F.col("p_retailprice").cast("decimal(12,2)") * 100).cast("long").alias("price"),
    )
    lines = tables.sales_lines(spark, sf_dir, "order_id", "line_number", "part_id", "supplier_id", "quantity")
    return projections.with_net_revenue(projections.with_revenue(lines.join(parts, "part_id"))).select(*columns)


PRICED = """
priced AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS part_id, l_suppkey AS supplier_id,
         p_type AS category,
         CAST(l_quantity AS BIGINT) * CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS revenue
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
net AS (
  SELECT *, revenue * CAST(0.10 AS DOUBLE) AS discount, revenue - revenue * CAST(0.10 AS DOUBLE) AS final_revenue FROM priced
)"""


@query(
    "discount_net",
    f"WITH {PRICED} SELECT order_id, line_number, part_id, supplier_id, revenue, discount, final_revenue FROM net",
)
def discount_net(spark, sf_dir):
    return _priced_lines(
        spark, sf_dir, "order_id", "line_number", "part_id", "supplier_id", "revenue", "discount", "final_revenue"
    )


@query(
    "least_category",
    f"""WITH {PRICED}
        SELECT category, {double('sum(CAST(final_revenue AS DECIMAL(18,4)))')} AS total_final_revenue
        FROM net GROUP BY category ORDER BY total_final_revenue, category LIMIT 1""",
)
def least_category(spark, sf_dir):
    lines = _priced_lines(spark, sf_dir, "category", "final_revenue")
    return sales.total_by(lines, ["category"], "final_revenue", "total_final_revenue", ascending=True).limit(1)


@query(
    "monthly_revenue",
    f"""WITH {SALES} SELECT CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month,
        {double('sum(sales)')} AS revenue FROM sales GROUP BY 1, 2""",
)
def monthly_revenue(spark, sf_dir):
    return sales.monthly_totals(tables.order_totals(spark, sf_dir, "order_date", "sales"), "sales", "revenue")


@query(
    "monthly_revenue_all_years",
    f"""WITH {SALES} SELECT CAST(month(order_date) AS INTEGER) AS month, {double('sum(sales)')} AS revenue
        FROM sales GROUP BY 1""",
)
def monthly_revenue_all_years(spark, sf_dir):
    orders = tables.order_totals(spark, sf_dir, "order_date", "sales")
    return sales.monthly_totals(orders, "sales", "revenue", merge_years=True)


MOVIES = "SELECT l_partkey AS movie_id, avg(l_quantity) AS avg_rating, count(l_quantity) AS total_ratings FROM lineitem GROUP BY 1"
WELL_RATED = f"{MOVIES} HAVING avg(l_quantity) >= 2.75"


@query("rating_summary", MOVIES)
def rating_summary(spark, sf_dir):
    return storage.movie_ratings(tables.ratings(spark, sf_dir))


@query("well_rated_movies", WELL_RATED)
def well_rated_movies(spark, sf_dir):
    return storage.well_rated(tables.ratings(spark, sf_dir))


@query("repartitioned_ratings", WELL_RATED)
def repartitioned_ratings(spark, sf_dir):
    ratings = tables.ratings(spark, sf_dir)
    return storage.well_rated(ratings.repartition(storage.partition_steps(ratings)[-1]))


@query("coalesced_ratings", WELL_RATED)
def coalesced_ratings(spark, sf_dir):
    ratings = tables.ratings(spark, sf_dir)
    few, _, many = storage.partition_steps(ratings)
    return storage.well_rated(ratings.repartition(many).coalesce(few))


@query("high_rating_count", "SELECT count(*) AS high_ratings FROM lineitem WHERE l_quantity >= 4.0")
def high_rating_count(spark, sf_dir):
    return storage.high_ratings(tables.ratings(spark, sf_dir))


@query(
    "user_min_max",
    "SELECT l_suppkey AS user_id, max(l_quantity) AS max_rating, min(l_quantity) AS min_rating FROM lineitem GROUP BY 1",
)
def user_min_max(spark, sf_dir):
    return storage.user_range(tables.ratings(spark, sf_dir))


@query("storage_strategies")
def storage_strategies(spark, sf_dir):
    return storage.strategy_report(tables.ratings(spark, sf_dir))


KPIS = f"""{SALES},
kpis AS (
  SELECT {double('sum(sales)')} AS total_sales, {double('sum(profit)')} AS total_profit,
         count(DISTINCT order_id) AS distinct_orders, count(DISTINCT customer_id) AS distinct_customers,
         {long('sum(quantity)')} AS total_quantity
  FROM sales
),
kpi AS (
  SELECT *, {ratio('total_sales', 'distinct_orders')} AS avg_order_value,
         {ratio('total_profit', 'total_sales')} * 100 AS profit_margin_pct FROM kpis
)"""


def _kpis(spark, sf_dir):
    customers = tables.customer_totals(spark, sf_dir, "customer_id", "orders", "sales", "profit", "quantity")
    return sales.kpi_row(customers, sales.CUSTOMER)


@query("kpi_row", f"WITH {KPIS} SELECT * FROM kpi")
def kpi_row(spark, sf_dir):
    return _kpis(spark, sf_dir)


@query(
    "kpi_long",
    f"""WITH {KPIS}
        SELECT 'Total Sales ($)' AS metric, '$' || format('{{:,.2f}}', total_sales) AS value FROM kpi
        UNION ALL SELECT 'Total Profit ($)', '$' || format('{{:,.2f}}', total_profit) FROM kpi
        UNION ALL SELECT 'Distinct Orders (#)', format('{{:,}}', distinct_orders) FROM kpi
        UNION ALL SELECT 'Distinct Customers (#)', format('{{:,}}', distinct_customers) FROM kpi
        UNION ALL SELECT 'Total Quantity Sold (#)', format('{{:,}}', total_quantity) FROM kpi
        UNION ALL SELECT 'Average Order Value ($)', '$' || format('{{:,.2f}}', avg_order_value) FROM kpi
        UNION ALL SELECT 'Overall Profit Margin (%)', format('{{:.2f}}', profit_margin_pct) || '%' FROM kpi""",
)
def kpi_long(spark, sf_dir):
    return sales.kpi_long(_kpis(spark, sf_dir))


def _summary(keys: str) -> str:
    return f"""WITH {SALES}, keyed AS (
          SELECT *, CAST(year(order_date) AS INTEGER) AS year,
                 year(order_date) || 'Q' || quarter(order_date) AS quarter FROM sales),
        totals AS (
          SELECT {keys}, {double('sum(sales)')} AS total_sales, {double('sum(profit)')} AS total_profit,
                 {long('sum(quantity)')} AS total_quantity, count(DISTINCT order_id) AS distinct_orders
          FROM keyed GROUP BY {keys})
        SELECT *, {percent('total_profit', 'total_sales')} AS profit_margin_pct FROM totals"""


@query("category_summary", _summary("category, sub_category"))
def category_summary(spark, sf_dir):
    lines = tables.sales_lines(
        spark, sf_dir, "order_id", "category", "sub_category", "sales", "profit", "quantity"
    )
    return sales.summary(lines, ["category", "sub_category"]).orderBy(F.desc("total_sales"), "category", "sub_category")


@query("region_summary", _summary("region, state"))
def region_summary(spark, sf_dir):
    customers = tables.customer_totals(spark, sf_dir, "orders", "region", "state", "sales", "profit", "quantity")
    return sales.summary(customers, ["region", "state"], sales.CUSTOMER).orderBy(F.desc("total_sales"), "region", "state")


@query("quarter_summary", _summary("year, quarter"))
def quarter_summary(spark, sf_dir):
    orders = tables.order_totals(spark, sf_dir, "order_id", "order_date", "sales", "profit", "quantity")
    keyed = orders.withColumns(
        {"year": F.year("order_date"), "quarter": dates.quarter_label(F.col("order_date"))}
    )
    return sales.summary(keyed, ["year", "quarter"], sales.ORDER).orderBy("year", "quarter")


@query(
    "monthly_trend",
    f"""WITH {SALES} SELECT strftime(order_date, '%Y-%m') AS year_month, {double('sum(sales)')} AS monthly_sales,
        {double('sum(profit)')} AS monthly_profit FROM sales GROUP BY 1""",
)
def monthly_trend(spark, sf_dir):
    return sales.monthly_trend(tables.order_totals(spark, sf_dir, "order_date", "sales", "profit"))


def _totals(key: str, expression: str) -> str:
    return f"""WITH {SALES} SELECT {expression} AS {key}, {double('sum(sales)')} AS sales,
        {double('sum(profit)')} AS profit FROM sales GROUP BY 1"""


@query("region_totals", _totals("region", "region"))
def region_totals(spark, sf_dir):
    return sales.totals_by(tables.customer_totals(spark, sf_dir, "region", "sales", "profit"), "region")


@query("quarter_totals", _totals("quarter", "year(order_date) || 'Q' || quarter(order_date)"))
def quarter_totals(spark, sf_dir):
    return sales.quarter_totals(tables.order_totals(spark, sf_dir, "order_date", "sales", "profit"))


@query("top10_sales", _total("product", "sales", "sales", "ORDER BY 2 DESC, 1 LIMIT 10"))
def top10_sales(spark, sf_dir):
    return sales.top_products(tables.part_totals(spark, sf_dir, "product", "sales"), "sales")


@query("top10_profit", _total("product", "profit", "profit", "ORDER BY 2 DESC, 1 LIMIT 10"))
def top10_profit(spark, sf_dir):
    return sales.top_products(tables.part_totals(spark, sf_dir, "product", "profit"), "profit")


@query(
    "loss_leaders",
    f"""WITH {SALES} SELECT product, category, sub_category, part_id, supplier_id, {double('sum(sales)')} AS total_sales,
        {double('sum(profit)')} AS total_profit,
        {ratio('sum(CAST(discount AS DECIMAL(18,4)))', 'count(discount)')} AS avg_discount,
        count(DISTINCT order_id) AS total_orders
        FROM sales GROUP BY product, category, sub_category, part_id, supplier_id HAVING sum(profit) < 0""",
)
def loss_leaders(spark, sf_dir):
    """Names repeat over many parts, and over all its suppliers no part loses: a product is a supplier's part."""
    lines = tables.sales_lines(spark, sf_dir, "order_id", "part_id", "supplier_id", "sales", "profit", "discount")
    # The lines are grouped by two numbers; only the products that lose money get their names.
    leaders = sales.loss_leaders(lines, ("part_id", "supplier_id"))
    named = leaders.join(tables.part_names(spark, sf_dir), "part_id", "left")
    columns = ("product", "category", "sub_category", "part_id", "supplier_id", "total_sales", "total_profit", "avg_discount", "total_orders")
    return named.select(*columns).orderBy("total_profit", "product", "category", "sub_category", "part_id", "supplier_id")


@query(
    "segment_aov",
    f"""WITH {SALES}, totals AS (
          SELECT segment, {double('sum(sales)')} AS total_sales, {double('sum(profit)')} AS total_profit,
                 count(DISTINCT customer_id) AS distinct_customers, count(DISTINCT order_id) AS distinct_orders
          FROM sales GROUP BY segment)
        SELECT *, round_even({ratio('total_sales', 'distinct_orders')}, 2) AS aov FROM totals""",
)
def segment_aov(spark, sf_dir):
    customers = tables.customer_totals(spark, sf_dir, "segment", "orders", "customer_id", "sales", "profit")
    return sales.segment_summary(customers, sales.CUSTOMER)


@query(
    "customer_leaderboard",
    f"""WITH {SALES} SELECT customer_id, customer_name, segment, {double('sum(sales)')} AS lifetime_spend,
        {double('sum(profit)')} AS net_profit, count(DISTINCT order_id) AS total_orders,
        {ratio('sum(sales)', 'count(*)')} AS avg_order_value
        FROM sales GROUP BY 1, 2, 3 ORDER BY lifetime_spend DESC, customer_id LIMIT 15""",
)
def customer_leaderboard(spark, sf_dir):
    customers = tables.customer_totals(
        spark, sf_dir, "customer_id", "customer_name", "segment", "orders", "sales", "profit", "lines"
    )
    return sales.customer_leaderboard(customers, grain=sales.CUSTOMER)


@query(
    "facet_filter",
    f"""WITH {SALES} SELECT category, segment, {double('sum(sales)')} AS sales, {double('sum(profit)')} AS profit
        FROM sales WHERE region = 'ASIA' AND category = 'PROMO' AND year(order_date) IN (1996, 1997)
        GROUP BY 1, 2""",
)
def facet_filter(spark, sf_dir):
    lines = tables.sales_lines(spark, sf_dir, "region", "category", "segment", "order_date", "sales", "profit")
    chosen = projections.facet_filter(lines, region="ASIA", category="PROMO", years=(1996, 1997))
    return chosen.groupBy("category", "segment").agg(
        sales.amount(chosen, "sales").alias("sales"), sales.amount(chosen, "profit").alias("profit")
    )


@query("facet_values", f"WITH {SALES} SELECT DISTINCT CAST(year(order_date) AS INTEGER) AS year FROM sales")
def facet_values(spark, sf_dir):
    orders = tables.orders_sold(spark, sf_dir, "order_date").select(F.year("order_date").alias("year"))
    return projections.distinct_values(orders, "year")


SHOWN = "order_id, line_number, part_id, customer_name, segment, region, state, category, sub_category, product, quantity, discount"


def _searched(spark, sf_dir, text, literal):
    """Names, products and states are matched once each, not on every line that has them."""
    searched = ("customer_name", "product", "state")
    marks = {f"hit_{c}": projections.matches(c, text, literal) for c in searched}
    lines = tables.sales_lines(spark, sf_dir, *SHOWN.split(", "), "sales", "profit", marks=marks)
    found = reduce(Column.__or__, [F.coalesce(F.col(c), F.lit(False)) for c in marks])
    return lines.filter(found | projections.matches("order_id", text, literal)).drop(*marks)


def _search_sql(condition: str) -> str:
    found = " OR ".join(
        condition.format(c) for c in ("customer_name", "product", "CAST(order_id AS VARCHAR)", "state")
    )
    return f"""WITH {SALES} SELECT {SHOWN}, {double('sales')} AS sales, {double('profit')} AS profit
        FROM sales WHERE {found}"""


@query("search", _search_sql("regexp_matches({}, '(?i)CUSTOMER#00000000[1-3]|^green .*T$|nation_7')"))
def search(spark, sf_dir):
    return _searched(spark, sf_dir, "CUSTOMER#00000000[1-3]|^green .*T$|nation_7", literal=False)


@query("search_literal", _search_sql("contains(lower({}), 'red w')"))
def search_literal(spark, sf_dir):
    return _searched(spark, sf_dir, "Red W", literal=True)


def _index_searched(spark, sf_dir, pattern, literal):
    """As ``_searched``, with the names, products and states found through their trigrams."""
    columns = {"customer_name": ("customer", "c_name"), "product": ("part", "p_name"), "state": ("nation", "n_name")}
    lines = tables.sales_lines(spark, sf_dir, *SHOWN.split(", "), "sales", "profit")
    found = projections.matches("order_id", pattern, literal)
    for name, (source, column) in columns.items():
        values = tables.table(spark, sf_dir, source).select(column)
        index = search_index.trigram_index(values, column)
        hits = search_index.matching_values(values, column, index, pattern, literal)
        lines = lines.join(hits.select(F.col("value").alias(name), F.lit(True).alias(f"hit_{name}")), name, "left")
        found = found | F.coalesce(F.col(f"hit_{name}"), F.lit(False))
    return lines.where(found).select(*SHOWN.split(", "), "sales", "profit")


@query("search_indexed", _search_sql("regexp_matches({}, '(?i)CUSTOMER#00000000[1-3]|^green .*T$|nation_7')"))
def search_indexed(spark, sf_dir):
    return _index_searched(spark, sf_dir, "CUSTOMER#00000000[1-3]|^green .*T$|nation_7", literal=False)


@query("search_literal_indexed", _search_sql("contains(lower({}), 'red w')"))
def search_literal_indexed(spark, sf_dir):
    return _index_searched(spark, sf_dir, "Red W", literal=True)


@query(
    "date_features",
    f"""WITH {SALES} SELECT order_id, line_number, part_id, supplier_id, CAST(year(order_date) AS INTEGER) AS year,
        year(order_date) || 'Q' || quarter(order_date) AS quarter, strftime(order_date, '%Y-%m') AS year_month,
        strftime(order_date, '%b') AS month_name, strftime(order_date, '%A') AS day_of_week,
        CAST(ship_date - order_date AS INTEGER) AS shipping_days FROM sales""",
)
def date_features(spark, sf_dir):
    lines = tables.sales_lines(
        spark, sf_dir, "order_id", "line_number", "part_id", "supplier_id", "order_date", "ship_date"
    )
    return projections.with_calendar(lines).drop("order_date", "ship_date")


LEVELS = {"all": (), "region": ("region",), "state": ("state",), "segment": ("segment",), "year": ("year",)}


def _distinct_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{level}' AS level, {"CAST(" + keys[0] + " AS VARCHAR)" if keys else "''"} AS name,
            count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS customers
            FROM (SELECT *, year(order_date) AS year FROM sales) {"GROUP BY " + keys[0] if keys else ""}"""
        for level, keys in LEVELS.items()
    )


@query("distinct_reports", f"WITH {SALES} {_distinct_sql()}")
def distinct_reports(spark, sf_dir):
    """Orders and customers in all, per region, state, segment and year, from one table of bitmaps."""
    orders = tables.orders_sold(spark, sf_dir, "order_id", "customer_id", "region", "state", "segment", "order_date")
    yearly = orders.withColumn("year", F.year("order_date").cast("string"))
    bitmaps = distinct.id_bitmaps(yearly, ["region", "state", "segment", "year"], {"orders": "order_id", "customers": "customer_id"})
    return distinct.distinct_reports(written(bitmaps, "id-bitmaps"), LEVELS, ["orders", "customers"])


@query(
    "retail_facts",
    f"""WITH {KPIS}, regions AS (SELECT region, sum(sales) AS sales FROM sales GROUP BY region)
        SELECT 'kpi' AS section, 'total_sales' AS metric, total_sales AS value FROM kpi
        UNION ALL SELECT 'kpi', 'total_profit', total_profit FROM kpi
        UNION ALL SELECT 'kpi', 'distinct_orders', distinct_orders FROM kpi
        UNION ALL SELECT 'kpi', 'distinct_customers', distinct_customers FROM kpi
        UNION ALL SELECT 'kpi', 'total_quantity', total_quantity FROM kpi
        UNION ALL SELECT 'kpi', 'avg_order_value', avg_order_value FROM kpi
        UNION ALL SELECT 'kpi', 'profit_margin_pct', profit_margin_pct FROM kpi
        UNION ALL SELECT 'region', region, {double('sales')} FROM regions""",
)
def retail_facts(spark, sf_dir):
    """Sections over one table of customers, so the order lines are read and joined once."""
    customers = tables.customer_totals(
        spark, sf_dir, "customer_id", "orders", "region", "sales", "profit", "quantity"
    )
    customers = written(customers, "customer-totals")
    kpis = sales.kpi_row(customers, sales.CUSTOMER)
    return reporting.report(
        {
            "kpi": (reporting.one_row(kpis), "metric", "value"),
            "region": (sales.totals_by(customers, "region"), "region", "sales"),
        }
    )
