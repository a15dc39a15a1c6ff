"""Display formats as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seriesloom.functions.arithmetic import in_millions, whole_part


MISSING = "n/a"


def plain(value: Column) -> Column:
    """Shortest text of a double, with an exponent only below 1e-4 and from 1e16 on."""
    size = F.abs(value)
    text = value.cast("string")
    small = _shortened(text.try_cast("decimal(38,24)").cast("string"))
    large = _shortened(text.try_cast("decimal(38,16)").cast("string"))
    power = F.regexp_extract(text, "E(-?)([0-9]+)$", 2)
    sign = F.when(F.contains(text, F.lit("E-")), "-").otherwise("+")
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    raised = F.concat(
        mantissa, F.lit("e"), sign, F.when(F.length(power) == 1, F.lit("0")).otherwise(""), power
    )
    shown = (
        F.when(F.isnan(value), "nan")
        .when(size == float("inf"), F.when(value > 0, "inf").otherwise("-inf"))
        .when((size >= 1e-4) & (size < 1e-3), small)
        .when((size >= 1e7) & (size < 1e16), large)
        .when((size > 0) & ((size < 1e-4) | (size >= 1e16)), raised)
        .otherwise(text)
    )
    return F.coalesce(shown, F.lit(MISSING))


def _shortened(digits: Column) -> Column:
    """Decimal text without zeros at its end, but for one after the point."""
    return F.regexp_replace(F.rtrim(digits, F.lit("0")), r"\.$", ".0")


def with_commas(value: Column) -> Column:
    """Whole number with thousands separators."""
    return F.coalesce(F.format_number(value, 0), F.lit(MISSING))


def fixed(value: Column, digits: int, suffix: str = "") -> Column:
    """Fixed number of digits, optionally followed by a unit.

    Rounds the double itself, not its shortest text: 2.675 lies below its text
    and gives 2.67, an exact half goes to the even digit.
    """
    scale = 10.0**digits
    scaled = value * scale
    # what the product lost by rounding, from the halves of the value
    spread = value * 134217729.0
    high = spread - (spread - value)
    lost = (high * scale - scaled) + (value - high) * scale
    half = scaled - F.floor(scaled) == 0.5
    whole = (
        F.when(half & (lost > 0), F.ceil(scaled).cast("double"))
        .when(half & (lost < 0), F.floor(scaled).cast("double"))
        .otherwise(F.rint(scaled))
    )
    places = F.abs(whole).try_cast("decimal(38,0)").cast("string")
    padded = F.lpad(places, F.greatest(F.length(places), F.lit(digits + 1)), F.lit("0"))
    negative = (value < 0) | (value.cast("string") == "-0.0")
    text = F.concat(
        F.when(negative, "-").otherwise(""),
        F.substr(padded, F.lit(1), F.length(padded) - digits),
        F.lit("." if digits else ""),
        F.right(padded, F.lit(digits)),
        F.lit(suffix),
    )
    # beyond the digits of a decimal a double is a whole number
    wide = F.concat(F.printf(F.lit(f"%.{digits}f"), value), F.lit(suffix))
    return F.when(value.isNotNull(), F.coalesce(text, wide)).otherwise(F.lit(MISSING))


def millions_label(value: Column) -> Column:
    """Whole millions followed by M, as on a chart axis."""
    return F.concat(whole_part(in_millions(value)).cast("string"), F.lit("M"))


def left_aligned(value: Column, width: int) -> Column:
    """Text padded on the right; longer text is kept whole."""
    text = value.cast("string")
    return F.rpad(text, F.greatest(F.length(text), F.lit(width)), F.lit(" "))
