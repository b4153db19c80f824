"""Numeric helpers: exact money, half-even rounding, consumer projection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillhouse.functions._util import as_col


def money(c, precision: int = 14, scale: int = 2) -> Column:
    return as_col(c).cast(f"decimal({precision},{scale})")


def half_even(c, digits: int = 0) -> Column:
    """Banker's rounding (the warehouse's float ``round`` and numpy's ``round``)."""
    return F.bround(as_col(c), digits)


def to_consumer(c) -> Column:
    """Decimal -> double in the last projection (what result consumers get)."""
    return as_col(c).cast("double")
