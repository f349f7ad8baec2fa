"""CSV inputs under the column names the operators expect. Each takes a file or a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gristmill.sources import schemas
from gristmill.sources.files import read_csv, read_first_available, snake_case


def order_lines(spark: SparkSession, path: str) -> DataFrame:
    """Order lines for the revenue reports: order_id, product, category, quantity, price, city."""
    return snake_case(read_csv(spark, path, schemas.ORDER_LINES)).withColumnRenamed("orderid", "order_id")


def ratings(spark: SparkSession, path: str) -> DataFrame:
    """user_id, movie_id, rating."""
    return read_csv(spark, path, schemas.RATINGS).toDF("user_id", "movie_id", "rating")


def prices(spark: SparkSession, path: str) -> DataFrame:
    """ts, stock, price; the series operators take ``order=("ts",)`` where a stock has one price per time."""
    return snake_case(read_csv(spark, path, schemas.PRICES)).withColumnRenamed("timestamp", "ts")


def posts(spark: SparkSession, path: str) -> DataFrame:
    """hashtag, day, region, platform. Blanks around a tag stay until ``trends.clean_posts``."""
    return snake_case(read_csv(spark, path, schemas.POSTS)).withColumnRenamed("date", "day")


def customers(spark: SparkSession, path: str) -> DataFrame:
    """customer_id, the four features, and the preferred category."""
    return read_csv(spark, path, schemas.CUSTOMERS)


def messages(spark: SparkSession, path: str) -> DataFrame:
    """label, message_text."""
    return read_csv(spark, path, schemas.MESSAGES)


def retail_orders(spark: SparkSession, *paths: str) -> DataFrame:
    """Retail lines from the first path that exists, dates as text; see ``quality.clean_sales``."""
    frame = snake_case(read_first_available(spark, paths, schemas.RETAIL_ORDERS))
    return frame.withColumnRenamed("product_name", "product")
