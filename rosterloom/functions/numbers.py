"""Rounding, ratios and numeric casts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, StringType

# Ratios are rounded from six exact decimals, so that ties go away from zero
# whatever the last bits of the binary quotient are.
_EXACT = "decimal(38,6)"


def zero_if_null(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit(0))


def round_to(column: Column, digits: int) -> Column:
    return F.round(column.cast(_EXACT), digits).cast("double")


def _quotient(numerator: Column, denominator: Column, scale: float) -> Column:
    return F.try_divide(numerator.cast("double") * F.lit(scale), denominator.cast("double"))


def guarded_ratio(numerator: Column, denominator: Column, digits: int,
                  scale: float = 1.0) -> Column:
    """Rounded ratio, **0** unless the denominator is positive."""
    return (F.when(denominator > 0, round_to(_quotient(numerator, denominator, scale), digits))
            .otherwise(F.lit(0.0)))


def nullable_ratio(numerator: Column, denominator: Column, digits: int,
                   scale: float = 1.0) -> Column:
    """Rounded ratio, **null** for a zero denominator."""
    return round_to(_quotient(numerator, denominator, scale), digits)


def hours(minutes: Column, digits: int = 2) -> Column:
    return F.round(minutes.cast("double") / F.lit(60.0), digits)


def as_integer(column: Column, data_type: DataType) -> Column:
    """Cast to INTEGER with rounding instead of Spark's truncation.

    Decimals and numeric text round half away from zero, binary floats half to
    even.
    """
    if isinstance(data_type, DecimalType):
        return F.round(column, 0).cast("int")
    if isinstance(data_type, (DoubleType, FloatType)):
        return F.bround(column, 0).cast("int")
    if isinstance(data_type, StringType):
        return F.round(column.cast(_EXACT), 0).cast("int")
    return column.cast("int")
