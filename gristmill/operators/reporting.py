"""Report facts as one tidy table ``(section, metric, value)``."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions import text
from gristmill.operators import projections, ranking, series, trends
from gristmill.session import written


def facts(section: str, frame: DataFrame, metric: str, value: str) -> DataFrame:
    """Two columns of a small result as facts of a section."""
    return frame.select(
        F.lit(section).alias("section"),
        F.col(metric).cast("string").alias("metric"),
        F.col(value).cast("double").alias("value"),
    )


def report(sections: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """All sections below each other: ``{section: (frame, metric column, value column)}``."""
    return reduce(DataFrame.unionByName, (facts(name, *columns) for name, columns in sections.items()))


def one_row(frame: DataFrame) -> DataFrame:
    """A one-row result of numbers as ``(metric, value)``."""
    doubles = frame.select(*(F.col(c).cast("double").alias(c) for c in frame.columns))
    return doubles.unpivot([], doubles.columns, "metric", "value")


def trend_facts(posts: DataFrame) -> DataFrame:
    """Facts of the trend report: size before and after cleaning, the top tags, and the categories.

    Everything follows from the counts per spelling, which are stored once; no section
    reads the posts again.
    """
    spellings = written(ranking.frequency(posts.fillna("", ["hashtag"]), ["hashtag"], "n"), "spellings")
    tags = trends.clean_posts(spellings).groupBy("hashtag").agg(F.sum("n").cast("long").alias("frequency"))
    sizes = spellings.agg(
        F.sum("n").alias("rows_in"),
        F.sum(F.when(~text.is_blank(F.col("hashtag")), F.col("n"))).alias("rows_out"),
    )
    categories = projections.categorise(tags, trends.TAG_CATEGORIES).groupBy("category")
    return report(
        {
            "size": (one_row(sizes), "metric", "value"),
            "tags": (one_row(tags.agg(F.count(F.lit(1)).alias("distinct_tags"))), "metric", "value"),
            "top": (ranking.most_frequent(tags, 10, "hashtag"), "hashtag", "frequency"),
            "category": (categories.agg(F.sum("frequency").alias("posts")), "category", "posts"),
        }
    )


def series_facts(performance: DataFrame) -> DataFrame:
    """Facts of the performance report: return and volatility of each series, and the best one."""
    best = series.best_performer(performance)
    return report(
        {
            "cumulative_return": (performance, "stock", "cumulative_return"),
            "volatility": (performance, "stock", "volatility"),
            "best": (best, "stock", "cumulative_return"),
        }
    )
