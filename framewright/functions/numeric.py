"""Numeric functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def power(c: Column, p) -> Column:
    """``c ** p`` as double (``POWER`` in SQL)."""
    return F.pow(c, p)


def round_half_up(c: Column, scale: int = 0) -> Column:
    """2.5 -> 3.0."""
    return F.round(c, scale)


def round_half_even(c: Column, scale: int = 0) -> Column:
    """2.5 -> 2.0 (banker's rounding)."""
    return F.bround(c, scale)
