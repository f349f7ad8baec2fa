"""Tables written to the shared folder by the writers and read back by the readers, with the SQL of the table itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.operators import projections, quality
from gristmill.plans.registry import Register
from gristmill.plans.sqltext import SALES
from gristmill.session import new_folder
from gristmill.sinks import files as sinks
from gristmill.sources import datasets, files, inference, tables

query = Register()

CUSTOMER = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
CUSTOMERS = "SELECT c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey, c_acctbal, c_mktsegment FROM customer"


def _customers(spark, sf_dir):
    return tables.table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS BIGINT) AS c_custkey", "c_name", "CAST(c_nationkey AS INT) AS c_nationkey", "c_acctbal", "c_mktsegment"
    )


@query("csv_round_trip", CUSTOMERS)
def csv_round_trip(spark, sf_dir):
    """A table as CSV in as many files as tasks, read with its schema."""
    path = new_folder(spark, "customer-csv")
    sinks.write_table(_customers(spark, sf_dir), path, kind="csv")
    return files.read_csv(spark, path, CUSTOMER)


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_day", "o_orderpriority", "o_note")


def _orders_as_text(spark, sf_dir):
    """Orders as CSV: whole numbers, decimals, dates, text, and a column without values."""
    path = new_folder(spark, "orders-csv")
    orders = tables.table(spark, sf_dir, "orders").withColumns(
        {"o_day": F.col("o_orderdate").cast("date"), "o_note": F.lit(None).cast("string")}
    )
    sinks.write_table(orders.select(*ORDER_COLUMNS), path, kind="csv")
    return path


@query(
    "csv_inferred",
    """SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
              CAST(o_totalprice AS DOUBLE) AS o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_day, o_orderpriority,
              CAST(NULL AS VARCHAR) AS o_note FROM orders""",
)
def csv_inferred(spark, sf_dir):
    """A table as CSV, read with the narrowest types that read all its values; the date is shown as text."""
    read = inference.read_inferred(spark, _orders_as_text(spark, sf_dir))
    assert dict(read.dtypes)["o_day"] == "date"
    return read.withColumn("o_day", F.col("o_day").cast("string"))


def _types_sql() -> str:
    whole = "CASE WHEN max({0}) < 2147483648 AND min({0}) >= -2147483648 THEN 'int' ELSE 'bigint' END"
    kinds = {
        "o_orderkey": whole.format("o_orderkey"), "o_custkey": whole.format("o_custkey"), "o_orderstatus": "'string'",
        "o_totalprice": "'double'", "o_day": "'date'", "o_orderpriority": "'string'", "o_note": "'string'",
    }
    source = "(SELECT *, CAST(o_orderdate AS DATE) AS o_day, CAST(NULL AS VARCHAR) AS o_note FROM orders)"
    return " UNION ALL ".join(
        f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, {kinds[c]} AS data_type, count({c}) AS filled FROM {source}"""
        for i, c in enumerate(ORDER_COLUMNS)
    )


@query("csv_inferred_types", _types_sql())
def csv_inferred_types(spark, sf_dir):
    raw = spark.read.csv(_orders_as_text(spark, sf_dir), header=True, inferSchema=False)
    return inference.inferred_types(raw)


RETAIL = {
    "Order ID": "CAST(order_id AS VARCHAR)", "Order Date": "CAST(order_date AS VARCHAR)", "Ship Date": "CAST(ship_date AS VARCHAR)",
    "Customer ID": "CAST(customer_id AS VARCHAR)", "Customer Name": "customer_name", "Segment": "segment", "Country": "state",
    "City": "state", "State": "state", "Postal Code": "CAST(line_number AS INTEGER)", "Region": "region",
    "Product ID": "CAST(part_id AS VARCHAR)", "Category": "category", "Sub-Category": "sub_category", "Product Name": "product",
    "Sales": "CAST(sales AS DOUBLE)", "Quantity": "CAST(quantity AS INTEGER)", "Discount": "CAST(discount AS DOUBLE)",
    "Profit": "CAST(profit AS DOUBLE)",
}


def _retail_name(name: str) -> str:
    return {"Product Name": "product"}.get(name, name.lower().replace(" ", "_").replace("-", "_"))


@query(
    "retail_csv",
    f"""WITH {SALES} SELECT {", ".join(f"{value} AS {_retail_name(name)}" for name, value in RETAIL.items())} FROM sales""",
)
def retail_csv(spark, sf_dir):
    """Order lines as the retail file with its nineteen columns, read by the reader of that file."""
    lines = tables.sales_lines(
        spark, sf_dir, "order_id", "order_date", "ship_date", "customer_id", "customer_name", "segment", "state", "line_number",
        "region", "part_id", "category", "sub_category", "product", "sales", "quantity", "discount", "profit",
    )
    path = new_folder(spark, "retail-csv")
    columns = [F.expr(value.replace("VARCHAR", "STRING").replace("INTEGER", "INT")).alias(name) for name, value in RETAIL.items()]
    sinks.write_table(lines.select(*columns), path, kind="csv", compression="gzip")
    return datasets.retail_orders(spark, new_folder(spark, "none"), path)


@query(
    "summary_files",
    """SELECT 'regions' AS report, n_name AS name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 2
       UNION ALL SELECT 'segments', c_mktsegment, count(*) FROM customer GROUP BY 2""",
)
def summary_files(spark, sf_dir):
    """Several summaries written in one call, a file each, and read back together."""
    customers = tables.table(spark, sf_dir, "customer")
    nations = tables.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("name"))
    reports = {
        "segments": customers.groupBy(F.col("c_mktsegment").alias("name")).agg(F.count("*").alias("customers")),
        "regions": customers.join(nations, "c_nationkey").groupBy("name").agg(F.count("*").alias("customers")),
    }
    folder = new_folder(spark, "summaries")
    sinks.write_reports(reports, folder, single_file=True)
    read = [
        files.read_csv(spark, f"{folder}/{name}", "name STRING, customers BIGINT").select(F.lit(name).alias("report"), "name", "customers")
        for name in reports
    ]
    return read[0].unionByName(read[1])


@query("filtered_download", f"{CUSTOMERS} WHERE contains(lower(c_name), '7') OR contains(lower(c_mktsegment), '7')")
def filtered_download(spark, sf_dir):
    """The rows that a search leaves, as the file to download, read back."""
    path = new_folder(spark, "download")
    sinks.write_table(projections.search(_customers(spark, sf_dir), "7", ["c_name", "c_mktsegment"], literal=True), path, kind="csv")
    return files.read_csv(spark, path, CUSTOMER)


GRID = ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


def _grid_sql(rows: int) -> str:
    cells = ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL') AS {c}" for c in GRID)
    widths = ", ".join(f"greatest({max(3, len(c))}, max(length({c}))) AS w_{c}" for c in GRID)
    rule = " || '+' || ".join(f"repeat('-', w_{c})" for c in GRID)
    names = " || '|' || ".join(f"lpad('{c}', CAST(w_{c} AS INTEGER), ' ')" for c in GRID)
    values = " || '|' || ".join(f"lpad({c}, CAST(w_{c} AS INTEGER), ' ')" for c in GRID)
    return f"""WITH chosen AS (SELECT c_custkey AS place, {cells} FROM customer ORDER BY place LIMIT {rows}),
        widths AS (SELECT {widths} FROM chosen),
        lines AS (SELECT -3 AS place, '+' || {rule} || '+' AS line FROM widths
            UNION ALL SELECT -2, '|' || {names} || '|' FROM widths UNION ALL SELECT -1, '+' || {rule} || '+' FROM widths
            UNION ALL SELECT place, '|' || {values} || '|' FROM chosen, widths
            UNION ALL SELECT 4611686018427387904, '+' || {rule} || '+' FROM widths)
        SELECT CAST(row_number() OVER (ORDER BY place) - 1 AS INTEGER) AS number, line FROM lines"""


@query("snapshot_grid", _grid_sql(20))
def snapshot_grid(spark, sf_dir):
    """The snapshot of the first twenty customers as the lines of a text grid."""
    customers = tables.table(spark, sf_dir, "customer").select(*GRID)
    return sinks.grid_lines(customers, 20, "c_custkey")


@query("report_round_trip", "SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY 1")
def report_round_trip(spark, sf_dir):
    """A report as one file in order, read back."""
    path = new_folder(spark, "segments-report")
    counts = _customers(spark, sf_dir).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))
    sinks.write_report(counts, path, order=["c_mktsegment"], single_file=True)
    return files.read_csv(spark, path, "c_mktsegment STRING, customers BIGINT")


@query("json_round_trip", "SELECT p_partkey, p_name, p_brand, CAST(NULL AS VARCHAR) AS p_note FROM part")
def json_round_trip(spark, sf_dir):
    """Documents as JSON lines; a field that no document has is null."""
    path = new_folder(spark, "part-json")
    sinks.write_table(tables.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand"), path, kind="json")
    return files.read_documents(spark, path, "p_partkey BIGINT, p_name STRING, p_brand STRING, p_note STRING")


@query("key_value_round_trip", "SELECT o_orderpriority AS key, count(*) AS value FROM orders GROUP BY 1")
def key_value_round_trip(spark, sf_dir):
    """Counts as lines of key, tab, value."""
    path = new_folder(spark, "priorities")
    counts = tables.table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("key"))
    sinks.write_key_values(counts.agg(F.count(F.lit(1)).alias("value")), path)
    return files.read_key_values(spark, path, "key STRING, value BIGINT")


@query("line_round_trip", "SELECT unnest(string_split(text, chr(10))) AS value FROM documents")
def line_round_trip(spark, sf_dir):
    """Texts as lines of a text file, one row per line."""
    path = new_folder(spark, "lines")
    sinks.write_table(tables.table(spark, sf_dir, "documents").select(F.col("text").alias("value")), path, kind="text")
    return files.read_lines(spark, path)


@query("preferred_input", f"{CUSTOMERS} WHERE c_acctbal >= 0")
def preferred_input(spark, sf_dir):
    """The cleaned table, as it is written by default, before the raw file."""
    raw, cleaned = new_folder(spark, "raw"), new_folder(spark, "cleaned")
    frame = _customers(spark, sf_dir)
    sinks.write_table(frame, raw, kind="csv")
    sinks.write_table(frame.where("c_acctbal >= 0"), cleaned)
    return files.read_first_available(spark, [cleaned, raw], CUSTOMER, ["parquet", "csv"])


@query("fallback_input", CUSTOMERS)
def fallback_input(spark, sf_dir):
    """The raw file where there is no cleaned table yet."""
    raw = new_folder(spark, "raw")
    sinks.write_table(_customers(spark, sf_dir), raw, kind="csv")
    return files.read_first_available(spark, [new_folder(spark, "none"), raw], CUSTOMER, ["parquet", "csv"])


@query("snapshot_round_trip", "SELECT s_suppkey, s_name FROM supplier")
def snapshot_round_trip(spark, sf_dir):
    return spark.read.parquet(sinks.write_snapshot(tables.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")))


@query(
    "schema_report",
    """SELECT CAST(row_number() OVER (ORDER BY column_index) - 1 AS INTEGER) AS position, column_name FROM duckdb_columns()
       WHERE table_name = 'nation' AND NOT internal""",
)
def schema_report(spark, sf_dir):
    return quality.schema_report(spark, tables.table(spark, sf_dir, "nation")).select("position", "column_name")
