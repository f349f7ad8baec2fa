"""Data-quality audits with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.operators import quality
from gristmill.plans.registry import Register
from gristmill.plans.sqltext import FEED, SALES, double, half_up, long, ratio
from gristmill.sources import tables

query = Register()


def _long(source: str, counts: dict[str, str], name: str = "metric", value: str = "value") -> str:
    """``(name, value)`` rows from aggregates over ``source``."""
    columns = ", ".join(f"{long(expression)} AS {metric}" for metric, expression in counts.items())
    rows = " UNION ALL ".join(f"SELECT '{metric}' AS {name}, {metric} AS {value} FROM counted" for metric in counts)
    return f"WITH {source}, counted AS (SELECT {columns} FROM checked) {rows}"


def _count_if(conditions: dict[str, str]) -> dict[str, str]:
    return {name: f"count(*) FILTER (WHERE {condition})" for name, condition in conditions.items()}


def _labelled(spark, sf_dir):
    labels = tables.table(spark, sf_dir, "labels")
    return tables.table(spark, sf_dir, "documents").join(labels, "doc_id", "left")


COUNTED = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels",
    "embeddings", "pages", "benchmark", "conversations",
)


@query("row_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in COUNTED))
def row_counts(spark, sf_dir):
    return quality.row_counts({name: tables.table(spark, sf_dir, name) for name in COUNTED})


@query(
    "null_counts",
    _long(
        "checked AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))",
        _count_if({c: f"{c} IS NULL" for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")}),
        "column_name",
        "missing",
    ),
)
def null_counts(spark, sf_dir):
    return quality.null_counts(_labelled(spark, sf_dir))


@query(
    "duplicate_keys",
    f"""WITH per_key AS (SELECT count(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber)
        SELECT {long('sum(copies)')} AS row_count, count(*) AS distinct_keys,
               {long('sum(copies - 1)')} AS duplicates FROM per_key""",
)
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(tables.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


FEED_COLUMNS = (
    "order_id, line_number, part_id, supplier_id, customer_id, return_flag, line_status, "
    "order_date, ship_date, sales, quantity, discount, profit"
)


@query(
    "duplicate_rows",
    f"""WITH {FEED}, copies AS (SELECT count(*) AS copies FROM feed GROUP BY {FEED_COLUMNS})
        SELECT {long('sum(copies)')} AS row_count, count(*) AS distinct_rows,
               {long('sum(copies - 1)')} AS duplicates FROM copies""",
)
def duplicate_rows(spark, sf_dir):
    return quality.duplicate_rows(tables.raw_feed(spark, sf_dir))


@query("distinct_documents", "SELECT DISTINCT lang, source, text FROM documents")
def distinct_documents(spark, sf_dir):
    return tables.table(spark, sf_dir, "documents").select("lang", "source", "text").dropDuplicates()


@query(
    "negative_counts",
    _long(
        f"{SALES}, checked AS (SELECT sales, profit, quantity, CAST(ship_date - order_date AS INTEGER) AS shipping_days FROM sales)",
        _count_if({c: f"{c} < 0" for c in ("sales", "profit", "quantity", "shipping_days")}),
    ),
)
def negative_counts(spark, sf_dir):
    lines = tables.sales_lines(spark, sf_dir, "sales", "profit", "quantity", "order_date", "ship_date")
    days = lines.withColumn("shipping_days", F.datediff("ship_date", "order_date"))
    return quality.negative_counts(days, ["sales", "profit", "quantity", "shipping_days"])


@query(
    "drop_missing_and_negative",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
       WHERE c_custkey IS NOT NULL AND c_name IS NOT NULL AND c_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL
         AND NOT isnan(c_acctbal) AND c_acctbal >= 0""",
)
def drop_missing_and_negative(spark, sf_dir):
    return quality.drop_missing_and_negative(tables.table(spark, sf_dir, "customer"), ["c_acctbal"])


@query(
    "invalid_dates",
    _long(
        f"{FEED}, checked AS (SELECT * FROM feed)",
        _count_if({c: f"TRY_CAST({c} AS DATE) IS NULL" for c in ("order_date", "ship_date")}),
    ),
)
def invalid_dates(spark, sf_dir):
    return quality.unreadable_dates(tables.raw_feed(spark, sf_dir, "order_date", "ship_date"), ["order_date", "ship_date"])


RANGES = {
    "non_positive_sales": "sales <= 0",
    "non_positive_quantity": "quantity <= 0",
    "invalid_discount": "discount < 0 OR discount > 1",
}


@query("range_checks", _long(f"{FEED}, checked AS (SELECT * FROM feed)", _count_if(RANGES)))
def range_checks(spark, sf_dir):
    return quality.range_checks(tables.raw_feed(spark, sf_dir, "sales", "quantity", "discount"))


PARSED = f"""{FEED},
parsed AS (
  SELECT * REPLACE (TRY_CAST(order_date AS DATE) AS order_date, TRY_CAST(ship_date AS DATE) AS ship_date)
  FROM (SELECT DISTINCT {FEED_COLUMNS} FROM feed)
),
cleaned AS (
  SELECT * FROM parsed
  WHERE order_date IS NOT NULL AND ship_date IS NOT NULL AND sales > 0 AND quantity > 0 AND discount >= 0
)"""


@query(
    "clean_pass",
    f"""WITH {PARSED}
        SELECT order_id, line_number, part_id, supplier_id, customer_id, return_flag, line_status,
               CAST(order_date AS VARCHAR) AS order_date, CAST(ship_date AS VARCHAR) AS ship_date,
               {double('sales')} AS sales, quantity, {double('discount')} AS discount, {double('profit')} AS profit,
               CAST(year(order_date) AS INTEGER) AS year, year(order_date) || 'Q' || quarter(order_date) AS quarter,
               strftime(order_date, '%Y-%m') AS year_month, strftime(order_date, '%b') AS month_name,
               strftime(order_date, '%A') AS day_of_week, CAST(ship_date - order_date AS INTEGER) AS shipping_days
        FROM cleaned""",
)
def clean_pass(spark, sf_dir):
    cleaned = quality.clean_sales(tables.raw_feed(spark, sf_dir))
    return cleaned.withColumns({c: F.col(c).cast("string") for c in ("order_date", "ship_date")})


def _report_sql() -> str:
    dated = "order_date IS NOT NULL AND ship_date IS NOT NULL"
    kept = f"{dated} AND sales > 0 AND quantity > 0 AND discount >= 0"
    counts = {
        "rows_in": "(SELECT count(*) FROM feed)",
        "duplicate_rows": "(SELECT count(*) FROM feed) - count(*)",
        **_count_if(
            {
                "invalid_order_dates": "order_date IS NULL",
                "invalid_ship_dates": "ship_date IS NULL",
                **{name: f"{dated} AND ({condition})" for name, condition in RANGES.items()},
                "negative_profit": f"{kept} AND profit < 0",
                "rows_out": kept,
            }
        ),
        "rows_dropped": f"(SELECT count(*) FROM feed) - count(*) FILTER (WHERE {kept})",
    }
    return _long(f"{PARSED}, checked AS (SELECT * FROM parsed)", counts)


@query("cleaning_report", _report_sql())
def cleaning_report(spark, sf_dir):
    return quality.cleaning_report(tables.raw_feed(spark, sf_dir))


@query(
    "negative_profit",
    f"""WITH {SALES}, counted AS (
          SELECT count(*) FILTER (WHERE profit < 0) AS negative_rows, count(*) AS row_count FROM sales)
        SELECT *, {half_up(ratio('negative_rows', 'row_count') + ' * 100', 1)} AS share_pct FROM counted""",
)
def negative_profit(spark, sf_dir):
    return quality.negative_profit(tables.sales_lines(spark, sf_dir, "profit"))


@query(
    "class_balance",
    """SELECT CASE WHEN quality = 0 THEN 'spam' ELSE 'ham' END AS label, count(*) AS count
       FROM documents JOIN labels USING (doc_id) WHERE length(trim(text)) > 0 GROUP BY 1""",
)
def class_balance(spark, sf_dir):
    return quality.class_balance(quality.clean_messages(tables.messages(spark, sf_dir)))
