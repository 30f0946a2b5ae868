"""Column functions: everything here stays inside Spark's built-in expressions."""

from .dates import iso_instant
from .numbers import midpoint, number, to_money
from .text import fill_blank, missing_as_null, strip

__all__ = [
    "fill_blank",
    "iso_instant",
    "midpoint",
    "missing_as_null",
    "number",
    "strip",
    "to_money",
]
