"""The star-schema tables, and the flat views of sales that the operators expect."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import numbers

ORDER_COLUMNS = {"order_date", "customer_id", "status"}
CUSTOMER_COLUMNS = {"customer_name", "segment"}
PLACE_COLUMNS = {"state", "region"}
PART_COLUMNS = {"category", "sub_category", "product"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """Give a table read by fewer tasks than there are cores one task per core.

    For work that is heavy per row, such as splitting long texts of a small table. A table
    of many files is read by more tasks than that already and passes without a shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select(*columns))


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.col("p_name").alias("product"),
        _cents(F.col("p_retailprice")).alias("unit_cost"),
    )


def part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """product, category and sub_category of every part."""
    return _parts(spark, sf_dir).select("part_id", "product", "category", "sub_category")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
    )


def _marked(dimension: DataFrame, marks: Mapping[str, Column]) -> DataFrame:
    """Add the ``marks`` whose column, named after ``hit_``, the dimension has: once per row of it."""
    own = {name: mark for name, mark in marks.items() if name.removeprefix("hit_") in dimension.columns}
    return dimension.withColumns(own) if own else dimension


def _with_customer(facts: DataFrame, sf_dir: str, wanted: set[str], marks: Mapping[str, Column]) -> DataFrame:
    spark = facts.sparkSession
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_id"),
    )
    customers = _marked(customers, marks)
    if wanted & PLACE_COLUMNS:
        nations = table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("nation_id"),
            F.col("n_name").alias("state"),
            F.col("n_regionkey").alias("region_id"),
        )
        regions = table(spark, sf_dir, "region").select(
            F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region")
        )
        customers = customers.join(_marked(nations, marks).join(regions, "region_id", "left"), "nation_id", "left")
    return facts.join(customers, "customer_id", "left")


def _with_dimensions(
    facts: DataFrame, sf_dir: str, wanted: set[str], marks: Mapping[str, Column] | None = None
) -> DataFrame:
    """Add what is wanted of order, customer, nation and region, joining no further than needed.

    The joined keys are unique, so these left joins neither drop nor repeat a row, and
    leaving one out cannot change a result. Customers are joined to the orders, so that
    the facts are shuffled once for both. Which side is broadcast is left to Spark, which
    decides by the measured size.
    """
    needs_customer = bool(wanted & (PLACE_COLUMNS | CUSTOMER_COLUMNS))
    if not (needs_customer or wanted & ORDER_COLUMNS):
        return facts
    orders = _orders(facts.sparkSession, sf_dir)
    if needs_customer:
        orders = _with_customer(orders, sf_dir, wanted, marks or {})
    return facts.join(orders, "order_id", "left")


def _cents(price: Column) -> Column:
    return F.rint(price * 100).cast("long")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines. ``units`` are the sales in ten-thousandths: cents times whole percent."""
    percent_kept = 100 - F.rint(F.col("l_discount") * 100).cast("long")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_linestatus").alias("line_status"),
        F.col("l_quantity").cast("long").alias("quantity"),
        F.col("l_discount").alias("discount"),
        (_cents(F.col("l_extendedprice")) * percent_kept).alias("units"),
    )


def sales_lines(
    spark: SparkSession, sf_dir: str, *columns: str, marks: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row per order line with just ``columns``.

    ``marks`` are further columns ``hit_<column>``, worked out on the part, customer or nation before the joins.
    """
    wanted = set(columns)
    lines = _lines(spark, sf_dir)
    if wanted & (PART_COLUMNS | {"profit"}):
        lines = lines.join(_marked(_parts(spark, sf_dir), marks or {}), "part_id", "left")
        cost = F.col("quantity") * F.col("unit_cost") * 100
        lines = lines.withColumn("profit", (F.col("units") - cost) / float(numbers.UNITS))
    lines = lines.withColumn("sales", F.col("units") / float(numbers.UNITS))
    return _with_dimensions(lines, sf_dir, wanted, marks).select(*columns, *(marks or {}))


def orders_sold(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One row per order that has lines, with ``columns`` of the order, its customer and place; nothing is summed."""
    orders = _lines(spark, sf_dir).select("order_id").distinct()
    return _with_dimensions(orders, sf_dir, set(columns)).select(*columns)


def order_totals(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One row per order with the sums ``sales``, ``profit``, ``quantity`` and the number of ``lines``.

    Order-level reports read this instead of the lines: the sums are built before the
    joins to customer and place, so those shuffle a row per order, also when one order
    or customer holds a large share of the lines.
    """
    wanted = set(columns)
    measures = [m for m in ("sales", "profit", "quantity") if m in wanted]
    lines = sales_lines(spark, sf_dir, "order_id", *measures)
    totals = lines.groupBy("order_id").agg(
        *(numbers.total(lines, m).alias(m) for m in measures), F.count(F.lit(1)).alias("lines")
    )
    return _with_dimensions(totals, sf_dir, wanted).select(*columns)


def customer_totals(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One row per customer with sums, the number of ``orders`` and the number of ``lines``.

    Each order has one customer, so counts of orders add up. Customers are joined to the
    finished sums, and a customer with a large share of all orders is one row by then.
    """
    wanted = set(columns)
    measures = [m for m in ("sales", "profit", "quantity") if m in wanted]
    orders = order_totals(spark, sf_dir, "order_id", "customer_id", *measures, "lines")
    totals = orders.groupBy("customer_id").agg(
        *(numbers.total(orders, m).alias(m) for m in measures),
        F.count("order_id").alias("orders"),
        F.sum("lines").alias("lines"),
    )
    if wanted & (PLACE_COLUMNS | CUSTOMER_COLUMNS):
        totals = _with_customer(totals, sf_dir, wanted, {})
    return totals.select(*columns)


def part_totals(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One row per part with the sums ``sales``, ``profit`` and ``quantity``, added up before the join."""
    lines = sales_lines(spark, sf_dir, "part_id", "sales", "quantity")
    totals = lines.groupBy("part_id").agg(
        numbers.total(lines, "sales").alias("sales"), F.sum("quantity").alias("quantity")
    )
    cost = F.col("quantity") * (F.col("unit_cost") / 100).cast("decimal(12,2)")
    return (
        totals.join(_parts(spark, sf_dir), "part_id", "left")
        .withColumn("profit", (F.col("sales") - cost).cast("decimal(38,4)"))
        .select(*columns)
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings of movies by users: suppliers rate parts with the quantity of each line."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("user_id"),
        F.col("l_partkey").alias("movie_id"),
        F.col("l_quantity").alias("rating"),
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price ticks: one series per event type, in order of time and event."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("stock"),
        "ts",
        F.col("event_id").alias("tick"),
        F.col("value").alias("price"),
    )


def event_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with a date: the tag is the event type."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("hashtag"), "ts", F.to_date("ts").alias("day")
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled messages: documents of quality 0 are spam, the others ham."""
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("quality") == 0, "spam").otherwise("ham").alias("label")
    )
    texts = documents(spark, sf_dir, "doc_id", "text").withColumnRenamed("text", "message_text")
    return texts.join(labels, "doc_id")


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order documents keyed by ``_id``."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("_id"),
        F.col("o_custkey").alias("customer"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.lit(1).cast("long").alias("quantity"),
    )


FEED = (
    "order_id", "line_number", "part_id", "supplier_id", "customer_id", "return_flag", "line_status",
    "order_date", "ship_date", "sales", "quantity", "discount", "profit",
)


def raw_feed(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Order lines as an untidy feed would bring them, with just ``columns`` (all, if none are named).

    Dates are text, and some cannot be read; returned lines come with a negative
    quantity; some lines carry an impossible discount or no sales; the finished first
    lines arrive twice. Every line of the table is there. Only tables that the columns
    need are joined.
    """
    wanted = columns or FEED
    status, flag, number = F.col("line_status"), F.col("return_flag"), F.col("line_number")
    marks = [c for c in ("line_number", "return_flag", "line_status") if c not in wanted]
    lines = sales_lines(spark, sf_dir, *wanted, *marks)
    untidy = {
        "order_date": lambda: F.when((flag == "N") & (number == 7), None).otherwise(F.col("order_date").cast("string")),
        "ship_date": lambda: F.when((status == "O") & (flag == "A") & (number == 6), "pending").otherwise(
            F.col("ship_date").cast("string")
        ),
        "sales": lambda: F.when((flag == "R") & (number == 5), 0).otherwise(F.col("sales")),
        "quantity": lambda: F.when((flag == "R") & (number == 4), -F.col("quantity")).otherwise(F.col("quantity")),
        "discount": lambda: F.when((flag == "R") & (number == 3), 1.5)
        .when((flag == "R") & (number == 2), -0.5)
        .otherwise(F.col("discount")),
    }
    copies = F.when((status == "F") & (flag == "A") & (number == 1), 2).otherwise(1)
    feed = lines.select(*(untidy[c]().alias(c) if c in untidy else F.col(c) for c in wanted), copies.alias("_copies"))
    return feed.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).drop("_copies", "_copy")
