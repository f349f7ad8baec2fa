"""Data-quality audits. Each audit is one aggregate over the table, never a job per column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from gristmill.functions import dates, numbers, text
from gristmill.operators import projections


def long_form(wide: DataFrame, name: str = "metric", value: str = "value") -> DataFrame:
    """One row of equally typed figures as ``(name, value)`` rows."""
    return wide.unpivot([], wide.columns, name, value)


def count_if(frame: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """How many rows meet each condition; an unknown (null) condition does not count."""
    return long_form(frame.agg(*(F.count_if(condition).alias(name) for name, condition in conditions.items())))


def _missing(frame: DataFrame) -> dict[str, Column]:
    return {
        field.name: numbers.is_missing(F.col(f"`{field.name}`"), isinstance(field.dataType, (DoubleType, FloatType)))
        for field in frame.schema.fields
    }


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each frame."""
    counts = (frame.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for name, frame in frames.items())
    return reduce(DataFrame.unionAll, counts)


def null_counts(frame: DataFrame) -> DataFrame:
    """Null or NaN values per column."""
    return count_if(frame, _missing(frame)).withColumnsRenamed({"metric": "column_name", "value": "missing"})


def duplicate_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys, and how many rows repeat a key; a key counts once also when it is null."""
    per_key = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("long").alias("row_count"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("long").alias("duplicates"),
    )


def duplicate_rows(frame: DataFrame) -> DataFrame:
    """How many rows are copies of an earlier row in all columns."""
    return duplicate_keys(frame, frame.columns).withColumnRenamed("distinct_keys", "distinct_rows")


def negative_counts(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    return count_if(frame, {c: F.col(c) < 0 for c in columns})


def drop_missing_and_negative(frame: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Rows with a value in every column and nothing below zero in the ``numeric`` ones."""
    kept = frame
    for missing in _missing(frame).values():
        kept = kept.filter(~missing)
    for column in numeric:
        kept = kept.filter(F.col(column) >= 0)
    return kept


def unreadable_dates(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text dates per column that are missing or cannot be read."""
    return count_if(frame, {c: dates.lenient_date(F.col(c)).isNull() for c in columns})


def range_checks(frame: DataFrame) -> DataFrame:
    """Sales and quantities not above zero, and discounts outside 0 to 1."""
    return count_if(
        frame,
        {
            "non_positive_sales": F.col("sales") <= 0,
            "non_positive_quantity": F.col("quantity") <= 0,
            "invalid_discount": (F.col("discount") < 0) | (F.col("discount") > 1),
        },
    )


def is_valid_sale(frame: DataFrame, drop_high_discount: bool = False) -> Column:
    """Positive sales and quantity, and no negative discount.

    A discount above 1 is reported by ``range_checks`` but stays, unless
    ``drop_high_discount``. NaN never passes, though Spark sorts it above all numbers.
    """
    floats = {f.name for f in frame.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    valid = (F.col("sales") > 0) & (F.col("quantity") > 0) & (F.col("discount") >= 0)
    for column in floats & {"sales", "quantity", "discount"}:
        valid = valid & ~F.isnan(column)
    return valid & (F.col("discount") <= 1) if drop_high_discount else valid


def parsed(frame: DataFrame) -> DataFrame:
    """Distinct rows with both dates read, unreadable ones null."""
    return frame.distinct().withColumns(
        {c: dates.lenient_date(F.col(c)) for c in ("order_date", "ship_date")}
    )


def clean_sales(raw: DataFrame, drop_high_discount: bool = False) -> DataFrame:
    """The cleaned table: copies removed, dates read, calendar keys added, impossible values dropped."""
    dated = parsed(raw).dropna(subset=["order_date", "ship_date"])
    return projections.with_calendar(dated).filter(is_valid_sale(raw, drop_high_discount))


def cleaning_report(raw: DataFrame) -> DataFrame:
    """What cleaning found, step by step, in a single pass.

    Grouping by all columns finds the copies; every later count needs only one row per
    group and its number of copies, so no step reads the table again.
    """
    grouped = raw.groupBy(*raw.columns).agg(F.count(F.lit(1)).alias("copies"))
    grouped = grouped.withColumns({c: dates.lenient_date(F.col(c)) for c in ("order_date", "ship_date")})
    dated = F.col("order_date").isNotNull() & F.col("ship_date").isNotNull()
    kept = dated & is_valid_sale(raw)
    counts = grouped.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("long").alias("rows_in"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("long").alias("duplicate_rows"),
        F.count_if(F.col("order_date").isNull()).alias("invalid_order_dates"),
        F.count_if(F.col("ship_date").isNull()).alias("invalid_ship_dates"),
        F.count_if(dated & (F.col("sales") <= 0)).alias("non_positive_sales"),
        F.count_if(dated & (F.col("quantity") <= 0)).alias("non_positive_quantity"),
        F.count_if(dated & ((F.col("discount") < 0) | (F.col("discount") > 1))).alias("invalid_discount"),
        F.count_if(kept & (F.col("profit") < 0)).alias("negative_profit"),
        F.count_if(kept).alias("rows_out"),
    )
    return long_form(counts.withColumn("rows_dropped", F.col("rows_in") - F.col("rows_out")))


def negative_profit(frame: DataFrame) -> DataFrame:
    """Rows sold at a loss and their share; they are valid and stay."""
    loss = F.col("profit") < 0
    return frame.agg(
        F.count_if(loss).alias("negative_rows"),
        F.count(F.lit(1)).alias("row_count"),
    ).withColumn("share_pct", F.round(numbers.ratio(F.col("negative_rows"), F.col("row_count")) * 100, 1))


def schema_report(spark: SparkSession, frame: DataFrame) -> DataFrame:
    """Name, type and nullability of every column."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(frame.schema.fields)]
    return spark.createDataFrame(rows, "position INT, column_name STRING, data_type STRING, nullable BOOLEAN")


def clean_messages(frame: DataFrame, label: str = "label", message: str = "message_text") -> DataFrame:
    """Messages with text and a label that is ham or spam after trimming and lower-casing."""
    # The two labels.
    labels = ("ham", "spam")
    return (
        frame.filter(~text.is_blank(F.col(message)))
        .withColumn(label, text.normalise_label(F.col(label)))
        .filter(F.col(label).isin(*labels))
    )


def class_balance(frame: DataFrame, label: str = "label") -> DataFrame:
    return frame.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
