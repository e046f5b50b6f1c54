"""Null handling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _subset(subset) -> list[str] | None:
    """``None`` = every column; a single name is one column; an empty list is no column."""
    if subset is None:
        return None
    return [subset] if isinstance(subset, str) else list(subset)


def first_non_null(*cols: Column | str) -> Column:
    """L1: ``coalesce``; give all inputs one type."""
    return F.coalesce(*[F.col(c) if isinstance(c, str) else c for c in cols])


def null_function_columns(a: str, b: str) -> list[Column]:
    """L2: ifnull, nullif, nvl, nvl2 on two columns of one type."""
    ca, cb = F.col(a), F.col(b)
    return [F.ifnull(ca, cb).alias("ifnull_ab"), F.nullif(ca, cb).alias("nullif_ab"),
            F.nvl(ca, cb).alias("nvl_ab"), F.nvl2(ca, cb, ca).alias("nvl2_ab")]


def drop_nulls(df: DataFrame, how: str = "any", subset: Sequence[str] | None = None) -> DataFrame:
    """L3/L4: drop rows where any / all of the (subset) columns are null; an empty subset checks
    no column and keeps every row."""
    cols = _subset(subset)
    if cols == []:
        return df
    return df.na.drop(how=how, subset=cols)


def fill_nulls(df: DataFrame, value, subset: Sequence[str] | None = None) -> DataFrame:
    """Fill nulls with one value; only columns of a matching type change."""
    cols = _subset(subset)
    return df if cols == [] else df.na.fill(value, cols)


def fill_nulls_by_column(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Per-column fill values."""
    return df.na.fill(dict(values))


def replace_values(df: DataFrame, to_replace, value, subset: Sequence[str] | None = None) -> DataFrame:
    """Replace given values in named columns."""
    cols = _subset(subset)
    return df if cols == [] else df.na.replace(to_replace, value, cols)
