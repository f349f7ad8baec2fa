"""Joins of a large table whose keys are uneven: heavy keys are measured and cut, light ones are joined as they are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.session import written

#: Pieces per shuffle partition that the rows are cut into; the more, the more even the partitions.
PIECES = 32


def heavy_keys(frame: DataFrame, keys: Sequence[str], pieces: int) -> DataFrame:
    """Keys with more rows than one of ``pieces`` even pieces of the table, and how many pieces they fill.

    Rows are counted per key in the tasks first. There are fewer of these keys than ``pieces``, whatever the table.
    """
    counts = written(frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "key-counts")
    total = counts.select(F.sum("_n")).first()[0] or 0
    least = max(1, -(-total // pieces))
    return counts.where(F.col("_n") > least).withColumn("_parts", F.ceil(F.col("_n") / least).cast("int")).drop("_n")


def _equal(left: DataFrame, right: DataFrame, keys: Sequence[str], names: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key, name in zip(keys, names):
        condition = condition & left[key].eqNullSafe(right[name])
    return condition


def join_heavy(
    large: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner", pieces_per_partition: int = PIECES
) -> DataFrame:
    """``large`` joined with ``small`` on ``keys`` so that no partition holds much more than its share of ``large``.

    ``how`` is inner, left or left_anti or left_semi. Rows of a heavy key are dealt to numbered pieces, and the rows
    of ``small`` with that key, and only those, are repeated once per piece; all other rows have piece 0. Null keys
    match nothing; in a left join they are dealt out too. The cut depends on the measured counts and the number of
    shuffle partitions, not on adaptive execution. A key that is heavy in ``small`` as well should rather be
    added up first: its rows are repeated.
    """
    spark = large.sparkSession
    pieces = int(spark.conf.get("spark.sql.shuffle.partitions")) * pieces_per_partition
    if how in ("inner", "left_semi"):
        large = large.dropna(subset=list(keys))
    heavy = heavy_keys(large, keys, pieces)
    names = [f"_{key}" for key in keys]
    # Fewer rows than pieces: small whatever the tables are.
    marks = F.broadcast(heavy.toDF(*names, "_parts"))
    dealt = large.join(marks, _equal(large, marks, keys, names), "left").drop(*names)
    dealt = dealt.withColumn("_piece", F.floor(F.rand(0) * F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts")
    repeated = small.join(marks, _equal(small, marks, keys, names), "left").drop(*names)
    number = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    repeated = repeated.withColumn("_piece", number).drop("_parts")
    return dealt.join(repeated, [*keys, "_piece"], how).drop("_piece")
