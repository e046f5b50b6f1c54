"""Projections and column shaping."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_names(df: DataFrame, *names: str) -> DataFrame:
    """Select by name, ``"*"`` allowed."""
    return df.select(*names)


def col_forms(name: str) -> tuple[Column, Column, Column]:
    """The three equivalent ways to name a column."""
    return F.col(name), F.column(name), F.expr(name)


def select_expressions(df: DataFrame, *exprs: str) -> DataFrame:
    """SQL expressions, aliases inside them (``a AS b``), comparisons as values."""
    return df.selectExpr(*exprs)


def with_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or replace several columns in one projection."""
    return df.withColumns(dict(columns))


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; names may hold spaces or dashes (P10: refer to them with backquotes)."""
    return df.withColumnsRenamed(dict(mapping))


def quoted(name: str) -> str:
    """P10: backquote a name for use inside a SQL expression string."""
    return "`" + name.replace("`", "``") + "`"


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop by name; unknown names are ignored."""
    return df.drop(*names)


def cast_columns(df: DataFrame, types: Mapping[str, str], safe: bool = False) -> DataFrame:
    """Cast named columns; ``safe`` uses ``try_cast`` so dirty text becomes null."""
    out = {}
    for name, typ in types.items():
        c = F.col(quoted(name))
        out[name] = c.try_cast(typ) if safe else c.cast(typ)
    return df.withColumns(out)


def flag_columns(df: DataFrame, source: str, words: Iterable[str], prefix: str = "is_") -> DataFrame:
    """One boolean column per word (``locate`` cast to boolean), then every column."""
    flags = [F.locate(w, F.col(source)).cast("boolean").alias(f"{prefix}{w}") for w in words]
    return df.select(*flags, "*")


def unique_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """A unique, increasing (not dense, not repeatable across runs) 64-bit id per row,
    computed inside each task without a shuffle."""
    return df.withColumn(name, F.monotonically_increasing_id())
