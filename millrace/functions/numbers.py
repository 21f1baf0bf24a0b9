"""Numeric columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def whole_part(value: Column) -> Column:
    """The integer part, cut towards zero; NULL where the value is no number."""
    return value.try_cast("double").try_cast("int")


def to_int(value: Column) -> Column:
    return value.try_cast("int")


def to_double(value: Column) -> Column:
    """A text as a double; NULL where it is no number. Java's type suffix (``2.5d``) is no number."""
    suffixed = F.lower(F.right(value, F.lit(1))).isin("d", "f") & ~F.endswith(F.lower(value), F.lit("inf"))
    return F.when(~suffixed, value.try_cast("double"))


def comma_decimal(value: Column) -> Column:
    """``'12,50'`` as 12.5."""
    return F.replace(value, F.lit(","), F.lit(".")).try_cast("double")


def round_half_even(value: Column, digits: int = 0) -> Column:
    return F.bround(value, digits)


def fixed_text(value: Column, digits: int = 1) -> Column:
    """Fixed number of decimals, ties to even."""
    return F.format_string(f"%.{digits}f", F.bround(value, digits))


def clamp(value: Column, low, high) -> Column:
    """Keep the value between two bounds; NULL stays NULL."""
    bounded = F.greatest(F.lit(low), F.least(F.lit(high), value))
    return F.when(value.isNotNull(), bounded)


def exact(value: Column, digits: int = 2) -> Column:
    """A double that has at most ``digits`` decimals as a decimal; others are rounded, so it is for amounts of money only."""
    return value.cast(f"decimal(18,{digits})")


def price_with_margin(cost: Column, margin: Column) -> Column:
    """``cost * (1 + margin)`` of the values as they are."""
    return cost * (F.lit(1) + margin)
