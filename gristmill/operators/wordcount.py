"""Word counts over text lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions import text
from gristmill.operators import ranking

# The words left out of the report of frequent words.
COMMON_WORDS = ("the", "is", "and", "of")


def word_count(lines: DataFrame, column: str = "value", leave_out: Sequence[str] = ()) -> DataFrame:
    """How often each lower-case word occurs. Counts are added up before the shuffle, so a
    frequent word sends one row per task."""
    words = lines.select(F.explode(text.words(F.col(column))).alias("word"))
    if leave_out:
        words = words.filter(~F.col("word").isin(*leave_out))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("total"))


def top_words(lines: DataFrame, column: str = "value", n: int = 10, leave_out: Sequence[str] = COMMON_WORDS) -> DataFrame:
    return ranking.most_frequent(word_count(lines, column, leave_out), n, "word", "total")
