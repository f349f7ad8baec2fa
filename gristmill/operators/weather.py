"""Yearly temperatures from fixed-width station lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.sources.files import fixed_width

# Positions counted from 1 and lengths of the fields, and the mark of a missing reading.
FIELDS = {"year": (16, 4, "int"), "temperature": (88, 5, "int"), "quality": (93, 1, "string")}
MISSING = 9999


def readings(lines: DataFrame, accepted_quality: Sequence[str] | None = None) -> DataFrame:
    """Year, temperature (tenths of a degree) and quality of each line with a reading.

    Lines too short or unreadable have none. All quality codes pass unless some are named.
    """
    parsed = fixed_width(lines, FIELDS).filter((F.col("temperature") != MISSING) & F.col("year").isNotNull())
    return parsed.filter(F.col("quality").isin(*accepted_quality)) if accepted_quality else parsed


def yearly(readings_frame: DataFrame) -> DataFrame:
    """Maximum, minimum and mean per year in one pass."""
    return readings_frame.groupBy("year").agg(
        F.max("temperature").alias("max_temperature"),
        F.min("temperature").alias("min_temperature"),
        F.avg("temperature").alias("avg_temperature"),
    )
