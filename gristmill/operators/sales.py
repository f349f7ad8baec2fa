"""Sales reports over a flat frame of sales.

The frame may hold single order lines or rows already added up, as long as it has the
columns a report names: sums and counts come out equal. ``grain`` says what a row is:

- ``LINE``: anything; orders and customers are counted by finding distinct ones,
- ``ORDER``: one order, so orders are counted without that shuffle,
- ``CUSTOMER``: one customer, with the number of ``orders``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions import dates, numbers


def amount(frame: DataFrame, measure: str) -> Column:
    """An exact total shown as a double."""
    return numbers.total(frame, measure).cast("double")


LINE, ORDER, CUSTOMER = "line", "order", "customer"


def _orders(grain: str) -> Column:
    counts = {LINE: F.countDistinct("order_id"), ORDER: F.count("order_id"), CUSTOMER: F.sum("orders")}
    return counts[grain].cast("long")


def _customers(grain: str) -> Column:
    return F.count("customer_id") if grain == CUSTOMER else F.countDistinct("customer_id")


def _added_up(frame: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per key with exact sums under their old names."""
    return frame.groupBy(*keys).agg(*(numbers.total(frame, m).alias(m) for m in measures))


def total_by(frame: DataFrame, keys: Sequence[str], measure: str, name: str, ascending: bool = False) -> DataFrame:
    """Sum per key, largest (or smallest) first, equal sums in key order."""
    totals = frame.groupBy(*keys).agg(amount(frame, measure).alias(name))
    return totals.orderBy(F.col(name).asc() if ascending else F.col(name).desc(), *keys)


def top_totals(frame: DataFrame, keys: Sequence[str], measure: str, name: str, n: int) -> DataFrame:
    return total_by(frame, keys, measure, name).limit(n)


def average_of(frame: DataFrame, measure: str, name: str) -> DataFrame:
    """Mean over all rows, as exact sum over count."""
    return frame.agg(numbers.ratio(numbers.total(frame, measure), F.count(measure)).alias(name))


def monthly_totals(frame: DataFrame, measure: str, name: str, merge_years: bool = False) -> DataFrame:
    """Sum per calendar month; ``merge_years`` puts the same month of all years together."""
    month = F.month("order_date").alias("month")
    keys = [month] if merge_years else [F.year("order_date").alias("year"), month]
    totals = frame.groupBy(*keys).agg(amount(frame, measure).alias(name))
    return totals.orderBy(*[c for c in totals.columns if c != name])


def with_margin(totals: DataFrame, profit: str = "total_profit", sales: str = "total_sales") -> DataFrame:
    return totals.withColumn("profit_margin_pct", numbers.percent(F.col(profit), F.col(sales)))


def summary(frame: DataFrame, keys: Sequence[str], grain: str = LINE) -> DataFrame:
    """Sales, profit, units, distinct orders and margin per group; rows without a key are left out."""
    totals = frame.dropna(subset=list(keys)).groupBy(*keys).agg(
        amount(frame, "sales").alias("total_sales"),
        amount(frame, "profit").alias("total_profit"),
        F.sum("quantity").cast("long").alias("total_quantity"),
        _orders(grain).alias("distinct_orders"),
    )
    return with_margin(totals)


def kpi_row(frame: DataFrame, grain: str = LINE) -> DataFrame:
    """Seven headline figures in one row.

    Two distinct counts over the raw rows would triple them first. Adding up per order and
    customer beforehand leaves far fewer rows to triple, and no order or customer, however
    large, reaches one task unsummed.
    """
    measures = ["sales", "profit", "quantity"]
    pairs = frame if grain != LINE else _added_up(frame, ["order_id", "customer_id"], measures)
    totals = pairs.agg(
        F.coalesce(amount(pairs, "sales"), F.lit(0.0)).alias("total_sales"),
        F.coalesce(amount(pairs, "profit"), F.lit(0.0)).alias("total_profit"),
        _orders(grain).alias("distinct_orders"),
        _customers(grain).alias("distinct_customers"),
        F.coalesce(F.sum("quantity").cast("long"), F.lit(0)).alias("total_quantity"),
    )
    return totals.select(
        "*",
        numbers.ratio(F.col("total_sales"), F.col("distinct_orders")).alias("avg_order_value"),
        F.when(F.col("total_sales") > 0, numbers.ratio(F.col("total_profit"), F.col("total_sales")) * 100)
        .otherwise(0.0).alias("profit_margin_pct"),
    )


def kpi_long(kpis: DataFrame) -> DataFrame:
    """The headline figures as ``(metric, value)`` text."""
    dollars = lambda c: F.concat(F.lit("$"), F.format_number(c, 2))
    number = lambda c: F.format_number(c, 0)
    # The metric names.
    shown = {
        "Total Sales ($)": dollars("total_sales"),
        "Total Profit ($)": dollars("total_profit"),
        "Distinct Orders (#)": number("distinct_orders"),
        "Distinct Customers (#)": number("distinct_customers"),
        "Total Quantity Sold (#)": number("total_quantity"),
        "Average Order Value ($)": dollars("avg_order_value"),
        "Overall Profit Margin (%)": F.concat(F.format_number("profit_margin_pct", 2), F.lit("%")),
    }
    wide = kpis.select(*(value.alias(name) for name, value in shown.items()))
    return wide.unpivot([], list(shown), "metric", "value")


def totals_by(frame: DataFrame, key: str, prefix: str = "") -> DataFrame:
    """Sales and profit per key, in key order."""
    return (
        frame.dropna(subset=[key])
        .groupBy(key)
        .agg(amount(frame, "sales").alias(f"{prefix}sales"), amount(frame, "profit").alias(f"{prefix}profit"))
        .orderBy(key)
    )


def monthly_trend(frame: DataFrame) -> DataFrame:
    months = frame.withColumn("year_month", dates.year_month(F.col("order_date")))
    return totals_by(months, "year_month", prefix="monthly_")


def quarter_totals(frame: DataFrame) -> DataFrame:
    return totals_by(frame.withColumn("quarter", dates.quarter_label(F.col("order_date"))), "quarter")


def top_products(frame: DataFrame, measure: str, n: int = 10) -> DataFrame:
    """The ``n`` products with the largest sum, shown from small to large."""
    best = top_totals(frame, ["product"], measure, measure, n)
    return best.orderBy(F.col(measure), F.col("product").desc())


def loss_leaders(frame: DataFrame, keys: Sequence[str] = ("product", "category", "sub_category")) -> DataFrame:
    """Products, as ``keys`` tell them apart, that lose money over all, worst first."""
    totals = frame.groupBy(*keys).agg(
        amount(frame, "sales").alias("total_sales"),
        amount(frame, "profit").alias("total_profit"),
        numbers.ratio(numbers.total(frame, "discount"), F.count("discount")).alias("avg_discount"),
        F.countDistinct("order_id").alias("total_orders"),
    )
    return totals.filter("total_profit < 0").orderBy("total_profit", *keys)


def segment_summary(frame: DataFrame, grain: str = LINE) -> DataFrame:
    """Sales, profit, customers, orders and average order value per segment."""
    pairs = frame if grain != LINE else _added_up(frame, ["segment", "order_id", "customer_id"], ["sales", "profit"])
    totals = pairs.groupBy("segment").agg(
        amount(pairs, "sales").alias("total_sales"),
        amount(pairs, "profit").alias("total_profit"),
        _customers(grain).alias("distinct_customers"),
        _orders(grain).alias("distinct_orders"),
    )
    return totals.withColumn("aov", F.bround(numbers.ratio(F.col("total_sales"), F.col("distinct_orders")), 2))


def customer_leaderboard(frame: DataFrame, n: int = 15, grain: str = LINE) -> DataFrame:
    """The ``n`` customers who spent most. The average is per line: a row is one, unless it has ``lines``."""
    lines = F.sum("lines") if "lines" in frame.columns else F.count("sales")
    keys = ["customer_id", "customer_name", "segment"]
    totals = frame.groupBy(*keys).agg(
        amount(frame, "sales").alias("lifetime_spend"),
        amount(frame, "profit").alias("net_profit"),
        _orders(grain).alias("total_orders"),
        numbers.ratio(numbers.total(frame, "sales"), lines).alias("avg_order_value"),
    )
    return totals.orderBy(F.desc("lifetime_spend"), "customer_id").limit(n)
