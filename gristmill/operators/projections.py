"""Row-wise operators: derived columns, filters, search."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions import dates, numbers, text


def with_revenue(frame: DataFrame, quantity: str = "quantity", price: str = "price") -> DataFrame:
    return frame.withColumn("revenue", numbers.revenue(F.col(quantity), F.col(price)))


def with_net_revenue(frame: DataFrame, rate: float = 0.10, amount: str = "revenue") -> DataFrame:
    """The discount at ``rate`` and what is left of the amount."""
    return frame.withColumn("discount", numbers.discount_of(F.col(amount), rate)).withColumn(
        "final_revenue", F.col(amount) - F.col("discount")
    )


def with_calendar(frame: DataFrame, order_date: str = "order_date", ship_date: str = "ship_date") -> DataFrame:
    """Calendar keys of the order date and the days until shipping (negative if shipped before)."""
    keys = dates.calendar_keys(F.col(order_date))
    return frame.withColumns({**keys, "shipping_days": F.datediff(F.col(ship_date), F.col(order_date))})


def categorise(
    frame: DataFrame,
    rules: Mapping[str, Sequence[str]],
    source: str = "hashtag",
    target: str = "category",
    otherwise: str = "Other",
) -> DataFrame:
    """The first category whose list holds the value, else ``otherwise``."""
    chosen = reduce(
        lambda rest, rule: F.when(F.col(source).isin(*rule[1]), rule[0]).otherwise(rest),
        reversed(list(rules.items())),
        F.lit(otherwise),
    )
    return frame.withColumn(target, chosen)


def not_blank(frame: DataFrame, column: str) -> DataFrame:
    return frame.filter(~text.is_blank(F.col(column)))


def facet_filter(
    frame: DataFrame,
    region: str | None = None,
    category: str | None = None,
    segment: str | None = None,
    years: Sequence[int] = (),
) -> DataFrame:
    """Rows of the chosen facets; a facet left open, also an empty list of years, keeps all."""
    for column, value in (("region", region), ("category", category), ("segment", segment)):
        if value is not None:
            frame = frame.filter(F.col(column) == value)
    if years:
        frame = frame.filter(F.year("order_date").isin(*years))
    return frame


def search(frame: DataFrame, query: str, columns: Sequence[str], literal: bool = False) -> DataFrame:
    """Rows where any of ``columns`` holds ``query``, ignoring case; an empty query keeps all."""
    if not query:
        return frame
    return frame.filter(reduce(Column.__or__, [matches(c, query, literal) for c in columns]))


def matches(column: str, query: str, literal: bool = False) -> Column:
    """Whether a column, as text, holds ``query``, ignoring case."""
    return text.contains_pattern(F.col(column).cast("string"), query, literal)


def grep(lines: DataFrame, pattern: str, column: str = "value") -> DataFrame:
    """Lines that match, ignoring case."""
    return lines.filter(text.contains_pattern(F.col(column), pattern))


def keep_values(frame: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    return frame.filter(F.col(column).isin(*values))


def distinct_values(frame: DataFrame, column: str) -> DataFrame:
    """The values of a column once each, sorted, as a filter list shows them."""
    return frame.select(column).distinct().orderBy(column)
