"""Samples and splits that come out the same on any cluster.

``DataFrame.sample`` and ``randomSplit`` depend on how rows lie in partitions. Here a
row's place is set by a hash of its content, so copies of a row stay together and a test
set shares no message with its training set.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def place(key: Column, seed: int | None = None) -> Column:
    """A number from 0 to 1 (exclusive), even over distinct keys; another seed gives independent numbers."""
    name = key.cast("string") if seed is None else F.concat(F.lit(f"{seed}:"), key.cast("string"))
    digits = F.substring(F.md5(name), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**32))


def sample(frame: DataFrame, key: str, fraction: float, seed: int | None = None) -> DataFrame:
    """About ``fraction`` of the distinct keys, with all their rows; the same for the same seed on any layout."""
    return frame.filter(place(F.col(key), seed) < fraction)


def exactly(frame: DataFrame, key: str, rows: int, seed: int | None = None) -> DataFrame:
    """Exactly ``rows`` rows (all, if there are fewer): those whose key has the smallest hash, ties by the key itself.

    The same rows for the same seed on any layout. Every task keeps its smallest ``rows``, and what they keep is
    merged, so nothing is sorted or shuffled as a whole. ``key`` names rows; of rows with one key any may be taken.
    """
    columns = frame.columns
    placed = frame.withColumn("_place", place(F.col(key), seed))
    return placed.orderBy("_place", key).limit(rows).select(*columns)


def with_part(
    frame: DataFrame, key: str, parts: Mapping[str, float], name: str = "part", seed: int | None = None
) -> DataFrame:
    """Name the part each row falls in; the fractions of ``parts`` add up to 1."""
    names, reached = list(parts), 0.0
    label = None
    for part in names[:-1]:
        reached += parts[part]
        below = F.col("_place") < round(reached, 9)
        label = F.when(below, part) if label is None else label.when(below, part)
    label = F.lit(names[-1]) if label is None else label.otherwise(names[-1])
    # The hash of a long text is computed once, in a column of its own.
    return frame.withColumn("_place", place(F.col(key), seed)).withColumn(name, label).drop("_place")
