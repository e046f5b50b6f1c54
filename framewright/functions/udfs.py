"""User-defined functions.

Arrow-batched pandas UDFs with a declared result type.  A native expression is always
preferable in the hot path (``F.pow``); these exist for logic that has none.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType


# The range of x whose cube fits in a signed 64-bit long.
CUBE_MIN, CUBE_MAX = -2_097_152, 2_097_151


def _make_cube_udf():
    # Built inside a function so the batch function travels to the Python workers by value:
    # workers need pandas, not this package on their path.
    low, high = CUBE_MIN, CUBE_MAX

    def cube(x: pd.Series) -> pd.Series:
        x = x.astype("Int64")            # a batch with nulls arrives as float64: back to exact integers
        if ((x < low) | (x > high)).any():
            raise ArithmeticError("long overflow in cube_long")
        return x * x * x

    return F.pandas_udf(cube, LongType())


cube_long = _make_cube_udf()
cube_long.__doc__ = """X1: ``x ** 3`` for a long column, one Arrow batch at a time; like the native
expression under ANSI mode, a result outside the long range raises instead of wrapping."""


def register_cube(spark: SparkSession, name: str = "cube_long") -> str:
    """Make the UDF callable from SQL under ``name``; returns the name."""
    spark.udf.register(name, cube_long)
    return name
