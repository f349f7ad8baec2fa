"""Word counts, pattern search and fixed-width weather lines, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.operators import projections, weather, wordcount
from gristmill.plans.registry import Register
from gristmill.sources import tables

query = Register()


def _lines(spark, sf_dir):
    """Every line of every document."""
    return tables.documents(spark, sf_dir, "doc_id", "text").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("line_number", "value")
    )


LINES = r"""
lines AS (
  SELECT doc_id, CAST(unnest(range(len(parts))) AS INTEGER) AS line_number, unnest(parts) AS value
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)
)"""

WORDS = r"""
words AS (
  SELECT word FROM (SELECT unnest(regexp_split_to_array(lower(text), '\s+')) AS word FROM documents) WHERE word <> ''
)"""


@query("word_count", f"WITH {WORDS} SELECT word, count(*) AS total FROM words GROUP BY 1")
def word_count(spark, sf_dir):
    return wordcount.word_count(tables.documents(spark, sf_dir, "text"), "text")


@query(
    "word_top10",
    f"""WITH {WORDS} SELECT word, count(*) AS total FROM words WHERE word NOT IN ('the', 'is', 'and', 'of')
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def word_top10(spark, sf_dir):
    return wordcount.top_words(tables.documents(spark, sf_dir, "text"), "text")


@query("grep", f"WITH {LINES} SELECT * FROM lines WHERE regexp_matches(value, '(?i)licen[sc]e|@')")
def grep(spark, sf_dir):
    return projections.grep(_lines(spark, sf_dir), "licen[sc]e|@")


def _weather_lines(spark, sf_dir):
    """Station lines written from the orders: the year of each, and a temperature from its price."""
    temperature = F.when(
        (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"), weather.MISSING
    ).otherwise(F.floor(F.col("o_totalprice") / 1000) - 250)
    return tables.table(spark, sf_dir, "orders").select(
        F.concat(
            F.lpad(F.col("o_orderkey").cast("string"), 15, "0"),
            F.date_format("o_orderdate", "yyyy"),
            F.repeat(F.lit("0"), 68),
            F.format_string("%+05d", temperature.cast("int")),
            F.substring("o_orderpriority", 1, 1),
        ).alias("value")
    )


READINGS = """
readings AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(floor(o_totalprice / 1000) - 250 AS INTEGER) AS temperature,
         substr(o_orderpriority, 1, 1) AS quality
  FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')
)"""

YEARLY = """SELECT year, max(temperature) AS max_temperature, min(temperature) AS min_temperature,
       avg(temperature) AS avg_temperature FROM readings"""


@query("weather_year", f"WITH {READINGS} {YEARLY} GROUP BY 1")
def weather_year(spark, sf_dir):
    return weather.yearly(weather.readings(_weather_lines(spark, sf_dir)))


@query("weather_year_checked", f"WITH {READINGS} {YEARLY} WHERE quality IN ('1', '2') GROUP BY 1")
def weather_year_checked(spark, sf_dir):
    return weather.yearly(weather.readings(_weather_lines(spark, sf_dir), accepted_quality=("1", "2")))


@query(
    "weather_readings",
    f"WITH {READINGS} SELECT year, temperature, quality, count(*) AS readings FROM readings GROUP BY 1, 2, 3",
)
def weather_readings(spark, sf_dir):
    parsed = weather.readings(_weather_lines(spark, sf_dir))
    return parsed.groupBy("year", "temperature", "quality").agg(F.count(F.lit(1)).alias("readings"))
