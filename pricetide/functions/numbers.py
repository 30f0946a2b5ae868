"""Number parsing and money."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import MONEY

# Plain and exponent notation only: no digit grouping, currency sign, hex, suffix or word.
NUMBER_PATTERN = r"^\s*[+-]?(\d+[.]?\d*|[.]\d+)([eE][+-]?\d+)?\s*$"


def number(text: Column) -> Column:
    """Text as a finite double, NULL when it is not one."""
    value = F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
    infinity = F.lit(float("inf"))
    return F.nullif(F.nullif(value, infinity), -infinity)


def midpoint(low: Column, high: Column) -> Column:
    """Average of the two ends of a price range, in double."""
    return (low + high) / F.lit(2.0)


def to_money(value: Column) -> Column:
    """Double as DECIMAL(12,2), half up on its shortest text; NULL when it does not fit."""
    return value.try_cast(MONEY)
