"""Types of text columns: the narrowest that reads every value, found in one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Whole and decimal numbers, dates and moments as files write them.
WHOLE, DECIMAL = r"^[+-]?\d{1,19}$", r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
DATE, MOMENT = r"^\d{4}-\d{2}-\d{2}$", r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?$"


def _reads(value: Column) -> dict[str, Column]:
    """Whether a value reads as each type; a type further on reads all that the ones it widens read."""
    whole = value.rlike(WHOLE)
    date = value.rlike(DATE) & value.try_cast("date").isNotNull()
    return {
        "boolean": F.lower(value).isin("true", "false"),
        "int": whole & value.try_cast("int").isNotNull(),
        "bigint": whole & value.try_cast("bigint").isNotNull(),
        "double": value.rlike(DECIMAL),
        "date": date,
        "timestamp": date | (value.rlike(MOMENT) & value.try_cast("timestamp").isNotNull()),
    }


def inferred_types(frame: DataFrame) -> DataFrame:
    """``position, column_name, data_type, filled`` of every text column.

    The lattice runs from boolean, from int over bigint to double, and from date to timestamp, each up to string; a
    column gets the first type that reads all its values, and string if it has none. Every value is tried against
    every type and the counts are added up, so parts of a table can be judged apart and their counts merged. ``filled``
    counts the values that are not null.
    """
    columns = frame.columns
    kinds = list(_reads(F.lit("")))
    parts = []
    for i, name in enumerate(columns):
        value = F.col(f"`{name}`")
        parts.append(
            F.struct(
                F.lit(i).alias("position"), F.lit(name).alias("column_name"), F.count(value).alias("filled"),
                *(F.count_if(reads).alias(kind) for kind, reads in _reads(value).items()),
            ).alias(f"c{i}")
        )
    counts = frame.agg(*parts).select(F.inline(F.array(*(f"c{i}" for i in range(len(columns))))))
    found = F.lit("string")
    for kind in reversed(kinds):
        found = F.when((F.col("filled") > 0) & (F.col(kind) == F.col("filled")), kind).otherwise(found)
    return counts.select("position", "column_name", found.alias("data_type"), "filled")


def read_inferred(spark: SparkSession, path: str, header: bool = True, null_values: Sequence[str] = ("",)) -> DataFrame:
    """A CSV file or folder with the types that ``inferred_types`` finds; one pass over the text, one row to the driver
    per column."""
    raw = spark.read.csv(path, header=header, inferSchema=False)
    for empty in null_values:
        raw = raw.select(*(F.nullif(F.col(f"`{c}`"), F.lit(empty)).alias(c) for c in raw.columns))
    types = {row["column_name"]: row["data_type"] for row in inferred_types(raw).collect()}
    return raw.select(*(F.col(f"`{c}`").cast(types[c]).alias(c) for c in raw.columns))
