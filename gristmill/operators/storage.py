"""Caching and partitioning, and a timed comparison of the choices.

Timed runs write to the ``noop`` sink. A ``count()`` would let the optimizer drop the
sort and the unused averages, and so time less than it seems to.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the least average rating of a well-rated movie.
WELL_RATED = 2.75
#: Rows that one task gets at most in a comparison of partitions.
TASK_ROWS = 4_000_000

Row = tuple[str, int, float]
REPORT = "strategy STRING, partitions INT, seconds DOUBLE"


@contextmanager
def stored(frame: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK_DESER) -> Iterator[DataFrame]:
    """Keep ``frame`` at a storage level, computed once here, and release it in the end."""
    kept = frame.persist(level)
    try:
        kept.count()
        yield kept
    finally:
        kept.unpersist()


def partitions_of(frame: DataFrame) -> int:
    return frame.rdd.getNumPartitions()


def partition_steps(frame: DataFrame, least: int = 8) -> tuple[int, int, int]:
    """A quarter, half and all of the frame's partitions, taken as ``least`` if there are fewer.

    A small table is compared at 2, 4 and 8; the steps of a large one grow with its rows, so
    that no step gives a task more than ``TASK_ROWS``, however many rows a partition of the frame has.
    """
    quarter = -(-frame.count() // TASK_ROWS)
    most = max(least, partitions_of(frame), 4 * quarter)
    return most // 4, most // 2, most


def seconds_for(*frames: DataFrame) -> float:
    """Wall-clock seconds to compute all rows of the frames one after the other."""
    start = time.perf_counter()
    for frame in frames:
        frame.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def movie_ratings(ratings: DataFrame) -> DataFrame:
    """Average and number of ratings per movie."""
    return ratings.groupBy("movie_id").agg(
        F.avg("rating").alias("avg_rating"), F.count("rating").alias("total_ratings")
    )


def well_rated(ratings: DataFrame, least: float = WELL_RATED) -> DataFrame:
    """Movies with at least that average, best first: the workload that is timed."""
    return movie_ratings(ratings).filter(F.col("avg_rating") >= least).orderBy(F.desc("avg_rating"), "movie_id")


def high_ratings(ratings: DataFrame, least: float = 4.0) -> DataFrame:
    return ratings.filter(F.col("rating") >= least).agg(F.count(F.lit(1)).alias("high_ratings"))


def user_range(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("user_id").agg(
        F.max("rating").alias("max_rating"), F.min("rating").alias("min_rating")
    )


def three_actions(ratings: DataFrame) -> float:
    """Seconds for three reports over the same ratings."""
    return seconds_for(movie_ratings(ratings), high_ratings(ratings), user_range(ratings))


def baseline_and_cached(ratings: DataFrame) -> list[Row]:
    seconds_for(well_rated(ratings))  # warm-up, not reported
    rows = [("uncached", partitions_of(ratings), seconds_for(well_rated(ratings)))]
    with stored(ratings) as kept:
        rows += [(f"cached, run {run}", partitions_of(kept), seconds_for(well_rated(kept))) for run in (1, 2)]
    return rows


def repartitioned(ratings: DataFrame) -> list[Row]:
    spread = [(n, ratings.repartition(n)) for n in partition_steps(ratings)]
    return [(f"repartition({n})", partitions_of(frame), seconds_for(well_rated(frame))) for n, frame in spread]


def reuse(ratings: DataFrame) -> list[Row]:
    rows = [("three actions, uncached", partitions_of(ratings), three_actions(ratings))]
    with stored(ratings) as kept:
        rows.append(("three actions, cached", partitions_of(kept), three_actions(kept)))
    return rows


def storage_levels(ratings: DataFrame) -> list[Row]:
    levels = {
        "MEMORY_ONLY": StorageLevel.MEMORY_ONLY,
        "MEMORY_AND_DISK": StorageLevel.MEMORY_AND_DISK_DESER,
        "DISK_ONLY": StorageLevel.DISK_ONLY,
    }
    rows = []
    for name, level in levels.items():
        with stored(ratings, level) as kept:
            rows.append((f"persist({name})", partitions_of(kept), seconds_for(well_rated(kept))))
    return rows


def shrinking(ratings: DataFrame) -> list[Row]:
    """From all cached partitions to a quarter: by a full shuffle, and by merging partitions."""
    end, _, start = partition_steps(ratings)
    with stored(ratings.repartition(start)) as kept:
        ways: dict[str, Callable[[int], DataFrame]] = {"repartition": kept.repartition, "coalesce": kept.coalesce}
        return [
            (f"{start} to {end} by {name}", partitions_of(way(end)), seconds_for(well_rated(way(end))))
            for name, way in ways.items()
        ]


def strategy_report(ratings: DataFrame) -> DataFrame:
    """All comparisons, with the gain over the uncached run in percent."""
    rows = (
        baseline_and_cached(ratings) + repartitioned(ratings) + reuse(ratings)
        + storage_levels(ratings) + shrinking(ratings)
    )
    base = rows[0][2]
    gains = [(*row, round((base - row[2]) / base * 100, 2)) for row in rows]
    return ratings.sparkSession.createDataFrame(gains, f"{REPORT}, gain_pct DOUBLE")
