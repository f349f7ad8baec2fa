"""Counts per key and the top of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions import numbers


def frequency(frame: DataFrame, keys: Sequence[str], name: str = "frequency") -> DataFrame:
    """Rows per key. Rows whose last key is null are not counted."""
    return frame.groupBy(*keys).agg(F.count(keys[-1]).alias(name))


def most_frequent(counts: DataFrame, n: int, item: str, measure: str = "frequency") -> DataFrame:
    """The ``n`` largest, equal ones in the order of ``item``."""
    return counts.orderBy(F.desc(measure), item).limit(n)


def first_n_per_group(
    counts: DataFrame, group: str, measure: str, item: str, n: int, name: str = "rank"
) -> DataFrame:
    """The ``n`` largest rows per group, equal ones in the order of ``item``.

    Spark keeps only ``n`` rows per group and task before the shuffle, so a group may be
    of any size.
    """
    order = Window.partitionBy(group).orderBy(F.desc(measure), item)
    return counts.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= n)


def top_n_with_ties(counts: DataFrame, group: str, measure: str, n: int, name: str = "rank") -> DataFrame:
    """Rows ranked 1 to ``n`` within their group; equal rows share a rank, so more than ``n`` may come.

    Ranking all rows of a group in one task would fail where a group has very many tied
    items. A rank depends only on how many items hold a larger value, so the ranking runs
    over one row per distinct value: at most ``n`` of those per group can rank within
    ``n``. The items then take their value's rank by an equi-join.
    """
    values = counts.groupBy(group, measure).agg(F.count(F.lit(1)).alias("_items"))
    best = first_n_per_group(values, group, measure, measure, n, "_place")
    above = Window.partitionBy(group).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    ranks = best.select(
        group, measure, (F.coalesce(F.sum("_items").over(above), F.lit(0)) + 1).cast("int").alias(name)
    ).filter(F.col(name) <= n)
    return counts.join(ranks, [group, measure])


def share_of_total(counts: DataFrame, measure: str, digits: int = 2, name: str = "share_pct") -> DataFrame:
    """Each row's part of the column's sum in percent."""
    total = counts.select(F.sum(measure)).scalar()
    return counts.withColumn(name, F.round(numbers.ratio(F.col(measure), total) * 100, digits))
