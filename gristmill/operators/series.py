"""Price series: neighbours, returns, moving mean, first and last, performance report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.operators import heavy, slicing

ORDER = ("ts", "tick")


def clean(frame: DataFrame, key: str = "stock", order: Sequence[str] = ORDER, value: str = "price") -> DataFrame:
    """Ticks that have a series, a time and a value; the operators below expect no nulls in these."""
    return frame.dropna(subset=[key, *order, value]).withColumn(value, F.col(value).cast("double"))


def period_return(price: Column, previous: Column, digits: int | None = 2) -> Column:
    """Change in percent; 0 where there is no previous price or it is 0."""
    change = F.when(previous.isNull() | (previous == 0), F.lit(0.0)).otherwise(
        F.try_divide(price - previous, previous) * 100
    )
    return change if digits is None else F.round(change, digits)


def with_previous(
    frame: DataFrame, key: str = "stock", order: Sequence[str] = ORDER, value: str = "price",
    slice_rows: int = slicing.SLICE_ROWS,
) -> DataFrame:
    """The previous value in the series, and the return against it."""
    carried = slicing.sliced_series(frame, key, order, 1, 0, slice_rows)
    window = slicing.window_by_slice(key, order)
    valued = carried.withColumn("previous_price", F.lag(value, 1).over(window))
    return slicing.own_rows(valued).withColumn(
        "daily_return", period_return(F.col(value), F.col("previous_price"))
    )


def with_next(
    frame: DataFrame, key: str = "stock", order: Sequence[str] = ORDER, value: str = "price",
    slice_rows: int = slicing.SLICE_ROWS,
) -> DataFrame:
    """The next value in the series, null at its end."""
    carried = slicing.sliced_series(frame, key, order, 0, 1, slice_rows)
    window = slicing.window_by_slice(key, order)
    return slicing.own_rows(carried.withColumn("next_price", F.lead(value, 1).over(window)))


def with_moving_mean(
    frame: DataFrame, key: str = "stock", order: Sequence[str] = ORDER, value: str = "price", periods: int = 3,
    slice_rows: int = slicing.SLICE_ROWS,
) -> DataFrame:
    """Mean of this and the preceding ``periods - 1`` values, of fewer at the start of the series."""
    carried = slicing.sliced_series(frame, key, order, periods - 1, 0, slice_rows)
    window = slicing.window_by_slice(key, order).rowsBetween(-(periods - 1), 0)
    valued = carried.withColumn("moving_average", F.round(F.avg(value).over(window), 2))
    return slicing.own_rows(valued)


def indicators(
    frame: DataFrame, key: str = "stock", order: Sequence[str] = ORDER, value: str = "price",
    slice_rows: int = slicing.SLICE_ROWS,
) -> DataFrame:
    """Previous value, return and 3-period mean together: one shuffle serves all of them."""
    carried = slicing.sliced_series(frame, key, order, 2, 0, slice_rows)
    window = slicing.window_by_slice(key, order)
    valued = carried.withColumns(
        {
            "previous_price": F.lag(value, 1).over(window),
            "moving_average": F.round(F.avg(value).over(window.rowsBetween(-2, 0)), 2),
        }
    )
    return slicing.own_rows(valued).withColumn(
        "daily_return", period_return(F.col(value), F.col("previous_price"))
    )


def summary(frame: DataFrame, key: str = "stock", value: str = "price") -> DataFrame:
    """Count, mean, maximum and minimum per series."""
    return frame.groupBy(key).agg(
        F.count(F.lit(1)).alias("observation_count"),
        F.round(F.avg(value), 2).alias("average_price"),
        F.round(F.max(value), 2).alias("maximum_price"),
        F.round(F.min(value), 2).alias("minimum_price"),
    )


def endpoints(frame: DataFrame, key: str = "stock", order: Sequence[str] = ORDER, value: str = "price") -> DataFrame:
    """First and last value of each series, found by aggregation in place of a full window."""
    moment = F.struct(*order)
    return frame.groupBy(key).agg(
        F.min_by(value, moment).alias("first_price"), F.max_by(value, moment).alias("last_price")
    )


def with_endpoints(frame: DataFrame, key: str = "stock", order: Sequence[str] = ORDER, value: str = "price") -> DataFrame:
    """First and last value of the series on each of its rows; a series of any length is dealt to many tasks."""
    return heavy.join_heavy(frame, endpoints(frame, key, order, value), [key])


def performance(
    frame: DataFrame, key: str = "stock", order: Sequence[str] = ORDER, value: str = "price",
    slice_rows: int = slicing.SLICE_ROWS,
) -> DataFrame:
    """Per series: first, last, mean, least and largest value, cumulative return, volatility; best first.

    Volatility is the sample deviation of the rounded returns, the leading 0 included.
    """
    returns = with_previous(frame, key, order, value, slice_rows)
    moment = F.struct(*order)
    first, last = F.min_by(value, moment), F.max_by(value, moment)
    report = returns.groupBy(key).agg(
        F.round(first, 2).alias("first_price"),
        F.round(last, 2).alias("last_price"),
        F.round(F.avg(value), 2).alias("average_price"),
        F.round(F.min(value), 2).alias("min_price"),
        F.round(F.max(value), 2).alias("max_price"),
        F.round(F.try_divide(last - first, first) * 100, 2).alias("cumulative_return"),
        F.round(F.stddev_samp("daily_return"), 2).alias("volatility"),
    )
    return report.orderBy(F.desc("cumulative_return"), key)


def best_performer(report: DataFrame, key: str = "stock") -> DataFrame:
    return report.orderBy(F.desc("cumulative_return"), key).limit(1)
