"""Price-series reports with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.operators import heavy, quality, reporting, series
from gristmill.plans.registry import Register
from gristmill.plans.sqltext import half_up
from gristmill.session import written
from gristmill.sources import tables

query = Register()

RETURNS = f"""
ticks AS (
  SELECT event_type AS stock, ts, event_id AS tick, value AS price,
         lag(value) OVER series AS previous_price, lead(value) OVER series AS next_price,
         avg(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS mean,
         first_value(value) OVER whole AS first_price, last_value(value) OVER whole AS last_price
  FROM events
  WINDOW series AS (PARTITION BY event_type ORDER BY ts, event_id),
         whole AS (PARTITION BY event_type ORDER BY ts, event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
),
returns AS (
  SELECT *, {half_up('mean')} AS moving_average,
         CASE WHEN previous_price IS NULL OR previous_price = 0 THEN 0.0
              ELSE {half_up('(price - previous_price) / previous_price * 100')} END AS daily_return
  FROM ticks
),
report AS (
  SELECT stock, {half_up('max(first_price)')} AS first_price, {half_up('max(last_price)')} AS last_price,
         {half_up('avg(price)')} AS average_price, {half_up('min(price)')} AS min_price,
         {half_up('max(price)')} AS max_price,
         {half_up('(max(last_price) - max(first_price)) / max(first_price) * 100')} AS cumulative_return,
         {half_up('stddev_samp(daily_return)')} AS volatility
  FROM returns GROUP BY stock
)"""


def _returns(columns: str) -> str:
    return f"WITH {RETURNS} SELECT {columns} FROM returns"


def _ticks(spark, sf_dir):
    return series.clean(tables.prices(spark, sf_dir))


@query(
    "price_summary",
    f"""SELECT event_type AS stock, count(*) AS observation_count, {half_up('avg(value)')} AS average_price,
        {half_up('max(value)')} AS maximum_price, {half_up('min(value)')} AS minimum_price FROM events GROUP BY 1""",
)
def price_summary(spark, sf_dir):
    return series.summary(_ticks(spark, sf_dir)).orderBy("stock")


@query("lag_return", _returns("stock, tick, price, previous_price, daily_return"))
def lag_return(spark, sf_dir):
    return series.with_previous(_ticks(spark, sf_dir)).drop("ts")


@query("lead_value", _returns("stock, tick, price, next_price"))
def lead_value(spark, sf_dir):
    return series.with_next(_ticks(spark, sf_dir)).drop("ts")


@query("moving_avg3", _returns("stock, tick, price, moving_average"))
def moving_avg3(spark, sf_dir):
    return series.with_moving_mean(_ticks(spark, sf_dir)).drop("ts")


INDICATORS = "stock, tick, price, previous_price, daily_return, moving_average"


@query("indicators", _returns(INDICATORS))
def indicators(spark, sf_dir):
    return series.indicators(_ticks(spark, sf_dir)).drop("ts")


@query("sliced_indicators", _returns(INDICATORS))
def sliced_indicators(spark, sf_dir):
    """The same as ``indicators``, with the series cut into many slices also where they are small."""
    return series.indicators(_ticks(spark, sf_dir), slice_rows=500).drop("ts")


@query("first_last", _returns("stock, tick, price, first_price, last_price"))
def first_last(spark, sf_dir):
    return series.with_endpoints(_ticks(spark, sf_dir)).drop("ts")


@query(
    "source_shares",
    """WITH sources AS (SELECT source, lang, count(*) AS documents, max(length(text)) AS longest FROM documents GROUP BY 1, 2)
       SELECT doc_id, d.source, d.lang, documents, CAST(longest AS INTEGER) AS longest,
              CAST(length(text) AS DOUBLE) / longest AS share_of_longest
       FROM documents d LEFT JOIN sources s ON d.source = s.source AND d.lang = s.lang""",
)
def source_shares(spark, sf_dir):
    """Every document with the figures of its source and language, of which a few hold most documents."""
    documents = tables.table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.length("text").alias("n"))
    figures = documents.groupBy("source", "lang").agg(F.count("*").alias("documents"), F.max("n").alias("longest"))
    joined = heavy.join_heavy(documents, figures, ["source", "lang"], "left")
    return joined.select(
        "doc_id", "source", "lang", "documents", "longest", (F.col("n").cast("double") / F.col("longest")).alias("share_of_longest")
    )


@query("series_report", f"WITH {RETURNS} SELECT * FROM report")
def series_report(spark, sf_dir):
    return series.performance(_ticks(spark, sf_dir))


@query("best_performer", f"WITH {RETURNS} SELECT * FROM report ORDER BY cumulative_return DESC, stock LIMIT 1")
def best_performer(spark, sf_dir):
    return series.best_performer(series.performance(_ticks(spark, sf_dir)))


@query(
    "series_facts",
    f"""WITH {RETURNS} SELECT 'cumulative_return' AS section, stock AS metric, cumulative_return AS value FROM report
        UNION ALL SELECT 'volatility', stock, volatility FROM report
        UNION ALL (SELECT 'best', stock, cumulative_return FROM report ORDER BY cumulative_return DESC, stock LIMIT 1)""",
)
def series_facts(spark, sf_dir):
    return reporting.series_facts(written(series.performance(_ticks(spark, sf_dir)), "performance"))


@query(
    "price_validation",
    """SELECT 'stock' AS column_name, count(*) FILTER (WHERE event_type IS NULL) AS missing FROM events
       UNION ALL SELECT 'ts', count(*) FILTER (WHERE ts IS NULL) FROM events
       UNION ALL SELECT 'tick', count(*) FILTER (WHERE event_id IS NULL) FROM events
       UNION ALL SELECT 'price', count(*) FILTER (WHERE value IS NULL OR isnan(value)) FROM events""",
)
def price_validation(spark, sf_dir):
    return quality.null_counts(tables.prices(spark, sf_dir))
