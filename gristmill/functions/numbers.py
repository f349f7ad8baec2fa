"""Number expressions: money, ratios, rounding, array distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

LOW_BITS = 16
DECIMALS = 4
UNITS = 10**DECIMALS


def total(frame: DataFrame, column: str, decimals: int = DECIMALS) -> Column:
    """Exact sum of amounts with up to ``decimals`` decimals, whatever order the rows arrive in.

    Adding doubles gives a result that varies with the order; decimals wide enough for any
    sum are slow per row. So amounts in doubles are counted in units of the last decimal, as
    64-bit integers split into a high and a low part, which leaves room for more than 10^13
    rows; only the two sums become decimals. An amount beyond 9 x 10^18 units, or with more
    decimals than that (beyond the rounding of doubles), is an error, never a wrong sum. NaN
    counts as missing. Decimal and integer columns are added as they are.
    """
    if not isinstance(frame.schema[column].dataType, (DoubleType, FloatType)):
        return F.sum(column)
    known = F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
    scaled = known * float(10**decimals)
    slack = F.greatest(F.lit(1e-4), F.abs(scaled) * 1e-14)
    too_fine = F.abs(scaled - F.rint(scaled)) > slack
    message = F.lit(f"{column} has amounts with more than {decimals} decimals")
    units = F.when(too_fine, F.raise_error(message).cast("long")).otherwise(F.rint(scaled).cast("long"))
    high = F.sum(F.shiftright(units, LOW_BITS)).cast("decimal(19,0)")
    low = F.sum(units.bitwiseAND(F.lit(2**LOW_BITS - 1).cast("long"))).cast("decimal(19,0)")
    whole = high * F.lit(2**LOW_BITS).cast("decimal(6,0)") + low
    unit = F.lit(f"{10**-decimals:.{decimals}f}").cast(f"decimal({max(1, decimals)},{decimals})")
    return (whole * unit).cast(f"decimal(38,{decimals})")


def revenue(quantity: Column, price: Column) -> Column:
    """Quantity times price in 64 bits; two 32-bit integers could overflow."""
    return quantity.cast("long") * price.cast("long")


def discount_of(amount: Column, rate: float = 0.10) -> Column:
    return amount * F.lit(rate)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, 0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share in percent, rounded half to even."""
    return F.bround(ratio(part, whole) * 100, digits)


def is_missing(value: Column, is_float: bool) -> Column:
    """Null, or NaN where the type has one; ``isnan`` on other types is an error."""
    return value.isNull() | F.isnan(value) if is_float else value.isNull()


def squared_distance(left: Column, right: Column) -> Column:
    """Squared Euclidean distance of two arrays of doubles."""
    squares = F.zip_with(left, right, lambda a, b: (a - b) * (a - b))
    return F.aggregate(squares, F.lit(0.0), lambda total, square: total + square)
