"""Series cut into slices of similar size.

A window over ``partitionBy(key)`` puts a whole series into one task. Where one key holds
a large share of the rows, that task cannot finish. Here the series are cut along their
order into slices, at quantiles of the order columns over all series, as many as the
number of rows asks for (one, if they are few), and windows run per key and slice. The few
rows that a window needs from before (or after) its slice are added to the slice as
carried rows and dropped from the result, so values are the same as over the whole series.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, TimestampType

from gristmill.functions.dates import seconds_of

#: Rows of all series together that a slice is meant to hold, and how many of them are sampled for the cuts.
SLICE_ROWS = 5_000_000
SAMPLED_PER_SLICE = 1_000

SLICE = "_slice"
CARRIED = "_carried"


def _numeric(frame: DataFrame, column: str):
    kind = frame.schema[column].dataType
    if isinstance(kind, NumericType):
        return F.col(column).cast("double")
    return seconds_of(F.col(column), zoned=isinstance(kind, TimestampType))


def _cuts(frame: DataFrame, column: str, slices: int, fraction: float) -> list[float]:
    """Quantiles of ``column``; one number per slice comes to the driver.

    Any cuts give right results, and they need only be roughly even, so they are taken
    from a sample, or from all rows where that sample is empty. No row is left out of the
    slices themselves.
    """
    if slices <= 1:
        return []
    steps = [i / slices for i in range(1, slices)]
    sampled = frame.sample(fraction, seed=1) if fraction < 1 else frame
    cuts = sampled.stat.approxQuantile(column, steps, 1 / (4 * slices))
    return cuts or (_cuts(frame, column, slices, 1.0) if fraction < 1 else [])


def _bucketed(frame: DataFrame, column: str, cuts: Sequence[float], name: str) -> DataFrame:
    if not cuts:
        return frame.withColumn(name, F.lit(0).cast("long"))
    splits = [-math.inf, *sorted(set(cuts)), math.inf]
    bucketizer = Bucketizer(splits=splits, inputCol=column, outputCol=name, handleInvalid="keep")
    return bucketizer.transform(frame).withColumn(name, F.col(name).cast("long"))


def with_slices(frame: DataFrame, order: Sequence[str], slices: int, fraction: float = 1.0) -> DataFrame:
    """Add ``_slice``: numbers that grow along ``order`` and mark about ``slices`` pieces of similar size.

    ``order`` is one or two columns without nulls: a time, and a number that tells equal
    times apart. A time so frequent that it fills more than one slice gets a slice to
    itself, which is then cut by the second column. The cuts are found from a ``fraction``
    of the rows.
    """
    timed = frame.withColumn("_time", _numeric(frame, order[0]))
    cuts = _cuts(timed, "_time", slices, fraction)
    heavy = sorted({time for time in cuts if cuts.count(time) > 1}) if len(order) > 1 else []
    sliced = _bucketed(timed, "_time", cuts + [math.nextafter(time, math.inf) for time in heavy], SLICE)
    if heavy:
        crowded = F.col("_time").isin(*heavy)
        tied = sliced.withColumn("_tie", F.when(crowded, _numeric(frame, order[1])).otherwise(F.lit(-math.inf)))
        tie_cuts = _cuts(tied.filter(crowded), "_tie", slices, fraction)
        pieces = len(set(tie_cuts)) + 1
        sliced = _bucketed(tied, "_tie", tie_cuts, "_piece")
        sliced = sliced.withColumn(SLICE, F.col(SLICE) * pieces + F.col("_piece"))
    return sliced.select(*frame.columns, SLICE)


def _edges(sliced: DataFrame, key: str, order: Sequence[str], rows: int, at_end: bool) -> DataFrame:
    """The first or last ``rows`` rows of each slice, as one sorted array per key and slice."""
    by_distance = [F.desc(c) if at_end else F.asc(c) for c in order]
    place = Window.partitionBy(key, SLICE).orderBy(*by_distance)
    edge = sliced.withColumn("_place", F.row_number().over(place)).filter(F.col("_place") <= rows)
    others = [c for c in sliced.columns if c not in (key, SLICE, *order)]
    return edge.groupBy(key, SLICE).agg(F.array_sort(F.collect_list(F.struct(*order, *others))).alias("_rows"))


def _carried(sliced: DataFrame, key: str, order: Sequence[str], rows: int, forward: bool) -> DataFrame:
    """Rows to add to each slice: the last ones before it (``forward``), or the first ones after it.

    A slice that exists has at least one row, so its ``rows`` nearest slices are enough.
    """
    along = Window.partitionBy(key).orderBy(SLICE)
    near = along.rowsBetween(-rows, -1) if forward else along.rowsBetween(1, rows)
    edges = _edges(sliced, key, order, rows, at_end=forward)
    nearest = edges.withColumn("_near", F.flatten(F.collect_list("_rows").over(near)))
    first = F.greatest(F.size("_near") - rows, F.lit(0)) + 1 if forward else F.lit(1)
    carried = nearest.select(key, SLICE, F.explode(F.slice("_near", first, F.lit(rows))).alias("_row"))
    own = (key, SLICE)
    return carried.select(*(F.col(c) if c in own else F.col(f"_row.{c}").alias(c) for c in sliced.columns))


def sliced_series(
    frame: DataFrame, key: str, order: Sequence[str], before: int = 0, after: int = 0, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """``frame`` in slices, each with ``before`` rows that precede it in its series and ``after`` that follow.

    Those rows are marked in ``_carried``. All series are cut at the same places, into as
    many slices as their rows together ask for. Per series and slice no more than
    ``before + after`` rows travel.
    """
    rows = frame.count()
    slices = max(1, -(-rows // slice_rows))
    sliced = with_slices(frame, order, slices, min(1.0, SAMPLED_PER_SLICE * slices / max(1, rows)))
    result = sliced.withColumn(CARRIED, F.lit(False))
    for near, forward in ((before, True), (after, False)):
        if near and slices > 1:
            extra = _carried(sliced, key, order, near, forward)
            result = result.unionByName(extra.withColumn(CARRIED, F.lit(True)))
    return result


def window_by_slice(key: str, order: Sequence[str]):
    """The window to use on such a frame."""
    return Window.partitionBy(key, SLICE).orderBy(*order)


def own_rows(frame: DataFrame) -> DataFrame:
    """Drop the carried rows and the marks again."""
    return frame.filter(~F.col(CARRIED)).drop(SLICE, CARRIED)
