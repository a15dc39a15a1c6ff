"""Changes, ratios, lines, bands and rounding as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 95 % normal quantile of the band, the share of the value used
# for the band when no error is known, and the display unit.
BAND_QUANTILE = 1.96
FALLBACK_LOWER = 0.98
FALLBACK_UPPER = 1.02
MILLION = 1_000_000.0

ZERO_BASES = ("null", "inf")


# What counts as a number in text: digits with a point and an exponent, or infinity.
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def lenient_double(value: Column, text: bool = True) -> Column:
    """Numeric value of a column; what cannot be read, and NaN, becomes missing.

    ``text`` says that the column holds text, of which the engine reads more than
    numbers: it also takes a type's letter at the end.
    """
    number = value.try_cast("double")
    if text:
        number = F.when(value.rlike(NUMBER), F.trim(value).try_cast("double"))
    return F.when(~F.isnan(number), number)


def pct_change(current: Column, previous: Column, zero_base: str = "null") -> Column:
    """Change against ``previous`` in percent.

    A previous value of 0 gives null, or with ``zero_base="inf"`` an infinity
    with the sign of ``current`` (null for 0 against 0). A missing previous
    value always gives null; nothing is padded.
    """
    if zero_base not in ZERO_BASES:
        raise ValueError(f"zero_base must be one of {ZERO_BASES}, not {zero_base!r}")
    change = (current / F.nullif(previous, F.lit(0.0)) - 1) * 100
    if zero_base == "null":
        return change
    infinity = F.lit(float("inf"))
    rise_from_zero = F.when(current > 0, infinity).when(current < 0, -infinity)
    return F.when(previous == 0, rise_from_zero).otherwise(change)


def step_change(current: Column, previous: Column) -> Column:
    """Change against ``previous`` in percent, for chained forecast rows."""
    return (current - previous) / F.nullif(previous, F.lit(0.0)) * 100


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is missing where the denominator is 0."""
    return numerator / F.nullif(denominator, F.lit(0.0))


def mean_of(values: Sequence[Column]) -> Column:
    """Mean of all values; missing as soon as one of them is."""
    total = values[0]
    for value in values[1:]:
        total = total + value
    return total / F.lit(float(len(values)))


def line_at(slope: Column, intercept: Column, period: Column, origin: int = 0) -> Column:
    """Value of a fitted line at ``period``."""
    return slope * (period - F.lit(origin)).cast("double") + intercept


def band(value: Column, rmse: Column) -> tuple[Column, Column]:
    """Lower and upper bound: constant width, or a share of the value without an error."""
    unknown = rmse.isNull() | (rmse == 0)
    margin = F.lit(BAND_QUANTILE) * rmse
    lower = F.when(unknown, value * F.lit(FALLBACK_LOWER)).otherwise(value - margin)
    upper = F.when(unknown, value * F.lit(FALLBACK_UPPER)).otherwise(value + margin)
    return lower, upper


def in_millions(value: Column) -> Column:
    return value / F.lit(MILLION)


def round_even(value: Column, digits: int) -> Column:
    """Round half to even."""
    return F.bround(value, digits)


def whole_part(value: Column) -> Column:
    """Integer part, cut toward zero."""
    return value.cast("bigint")
