"""Filters and predicates.

Predicates are plain Columns, so Catalyst merges chained filters and pushes the parts that a
Parquet scan understands into ``PushedFilters``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def where(df: DataFrame, *predicates: Column | str) -> DataFrame:
    """chained filters are one conjunction after optimisation."""
    for p in predicates:
        df = df.where(p)
    return df


def is_even(c: Column | str) -> Column:
    """modulo predicate."""
    return (F.col(c) if isinstance(c, str) else c) % 2 == 0


def member_of(c: Column | str, values: Iterable) -> Column:
    """set membership."""
    return (F.col(c) if isinstance(c, str) else c).isin(list(values))


def contains_text(c: Column | str, needle: str) -> Column:
    """substring present (``instr`` is 1-based, 0 when absent)."""
    return F.instr(F.col(c) if isinstance(c, str) else c, needle) >= 1


def any_of(*flags: Column) -> Column:
    """OR over generated flags."""
    out = flags[0]
    for f in flags[1:]:
        out = out | f
    return out


def all_of(*flags: Column) -> Column:
    """F8: AND of columns."""
    out = flags[0]
    for f in flags[1:]:
        out = out & f
    return out


def like_not_null(df: DataFrame, column: str, pattern: str, not_null: Iterable[str] = ()) -> DataFrame:
    """LIKE pattern and IS NOT NULL checks."""
    cond = F.col(column).like(pattern)
    for c in not_null:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def time_split(df: DataFrame, ts: str, cut: str) -> tuple[DataFrame, DataFrame]:
    """two half-open ranges on one cut, ``ts < cut`` and ``ts >= cut``; the cut literal is
    cast to the column's type so the comparison is pushed to the scan."""
    typ = dict(df.dtypes)[ts]
    cut_col = F.lit(cut).cast(typ)
    return df.where(F.col(ts) < cut_col), df.where(F.col(ts) >= cut_col)
