"""Money and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

#: Numbers as delivered: no digit of a premium may be lost, since premiums are part of a sale's key.
MONEY = "decimal(38,10)"


def coerce_number(text: Column) -> Column:
    """Text to money; what is not a number becomes null."""
    return strip(text.cast("string")).try_cast(MONEY)


def coerce_number_or_zero(text: Column) -> Column:
    return F.coalesce(coerce_number(text), F.lit(0).cast(MONEY))


def safe_rate(numerator: Column, denominator: Column) -> Column:
    """n/d, and 0 where d is null, zero or negative."""
    quotient = numerator.cast("double") / denominator.cast("double")
    return F.when(denominator > 0, quotient).otherwise(F.lit(0.0))


def safe_rate_one(numerator: Column, denominator: Column) -> Column:
    """Older rule: a zero denominator counts as one."""
    divisor = F.when(denominator == 0, F.lit(1.0)).otherwise(denominator.cast("double"))
    return numerator.cast("double") / divisor
