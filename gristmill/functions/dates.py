"""Date expressions: safe parsing and calendar keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_date(text: Column) -> Column:
    """The date in ``text``, or null where it holds none."""
    return text.try_cast("date")


def year_month(day: Column) -> Column:
    """``2021-04``; cut from the date's text, which is much cheaper than a date pattern."""
    return F.substring(day.cast("date").cast("string"), 1, 7)


def quarter_label(day: Column) -> Column:
    """``2021Q2``."""
    return F.concat(F.substring(day.cast("date").cast("string"), 1, 4), F.lit("Q"), F.quarter(day))


def calendar_keys(day: Column) -> dict[str, Column]:
    """Keys to group by: year, quarter, month, names of month and weekday."""
    return {
        "year": F.year(day),
        "quarter": quarter_label(day),
        "year_month": year_month(day),
        "month_name": F.monthname(day),
        "day_of_week": F.date_format(day, "EEEE"),
    }


def seconds_of(moment: Column, zoned: bool = False) -> Column:
    """Seconds since 1970: of the instant for a timestamp with a zone, else of the wall clock.

    A zoned timestamp's hours and minutes go back where the session's clocks do; its instant never does.
    """
    if zoned:
        return F.unix_micros(moment).cast("double") / 1_000_000
    return (
        F.unix_date(F.to_date(moment)) * F.lit(86400.0)
        + F.hour(moment) * 3600
        + F.minute(moment) * 60
        + F.date_part(F.lit("SECOND"), moment).cast("double")
    )
