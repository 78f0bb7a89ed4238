"""Numeric expressions with the semantics the metrics rely on: guarded casts, half-even rounding, floored division, finite ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_int(text: Column) -> Column:
    """Integer of a text that is an integer literal, else null (also true/false, decimals and what overflows)."""
    return F.when(F.trim(text).rlike(r"^[+-]?\d+$"), F.trim(text).try_cast("bigint"))


def as_float(text: Column) -> Column:
    """Double of a numeric text, else null (also true/false); NaN and infinities are numbers here."""
    return F.trim(text).try_cast("double")


def finite_between(value: Column, low: float, high: float) -> Column:
    """The value if it is finite and within [low, high], else null."""
    return F.when(~F.isnan(value) & value.between(low, high), value)


def truthy_or(value: Column, other: Column) -> Column:
    """``other`` where the value is null or zero."""
    return F.coalesce(F.when(value != 0, value), other)


def settled(value: Column) -> Column:
    """The value, evaluated once where it stands: always the same to us, but not to the optimizer, which would else copy the
    expressions below into every filter and column above."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def positive(value: Column) -> Column:
    """Null for sentinels: zero and negative values."""
    return F.when(value > 0, value)


def rounded(value: Column, digits: int = 6) -> Column:
    """Rounded half up, never a negative zero."""
    return F.round(value, digits) + 0.0


def logistic(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))

