"""Struct, array, map and JSON operators.

ANSI mode stays on: element access that may miss uses ``get`` / ``try_element_at`` (null when
out of range) rather than ``a[i]``, which raises.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def make_struct(*cols: Column | str) -> Column:
    """C1."""
    return F.struct(*[_c(c) for c in cols])


def field(struct_col: Column | str, name: str) -> Column:
    """``getField``; ``col("s.f")`` and ``select("s.*")`` are the other forms."""
    return _c(struct_col).getField(name)


def element(array_col: Column | str, index: int) -> Column:
    """Zero-based element, null when out of range."""
    return F.get(_c(array_col), index)


def array_size(array_col: Column | str) -> Column:
    """C4: number of elements; null for a null array."""
    return F.size(_c(array_col))


def has_element(array_col: Column | str, value) -> Column:
    """C5."""
    return F.array_contains(_c(array_col), value)


def explode_array(df: DataFrame, array_col: str, name: str, position: str | None = None) -> DataFrame:
    """One row per element, rows with a null or empty array vanish; with ``position`` the
    zero-based element index is kept too."""
    others = [c for c in df.columns if c != array_col]
    if position:
        return df.select(*others, F.posexplode(F.col(array_col)).alias(position, name))
    return df.select(*others, F.explode(F.col(array_col)).alias(name))


def map_from_columns(df: DataFrame, key: str, value: str, name: str = "m") -> DataFrame:
    """A one-entry map per row; rows with a null key are dropped first (a null map key raises)."""
    return df.where(F.col(key).isNotNull()).withColumn(name, F.create_map(F.col(key), F.col(value)))


def map_lookup(map_col: Column | str, key) -> Column:
    """Value for a key, null when the key is missing."""
    return F.try_element_at(_c(map_col), F.lit(key) if not isinstance(key, Column) else key)


def explode_map(df: DataFrame, map_col: str, key: str = "key", value: str = "value") -> DataFrame:
    """One (key, value) row per entry."""
    others = [c for c in df.columns if c != map_col]
    return df.select(*others, F.explode(F.col(map_col)).alias(key, value))


def json_path(json_col: Column | str, path: str) -> Column:
    """JSON path (``$.a.b[0]``) as text."""
    return F.get_json_object(_c(json_col), path)


def json_fields(df: DataFrame, json_col: str, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """C11: top-level JSON fields to text columns named after the fields."""
    return df.select(*keep, F.json_tuple(F.col(json_col), *fields).alias(*fields))


def to_json_text(*cols: Column | str) -> Column:
    """Struct of the columns as JSON text; null fields are omitted."""
    return F.to_json(F.struct(*[_c(c) for c in cols]))


def parse_json(json_col: Column | str, schema: StructType | str) -> Column:
    """JSON text to a struct by declared schema."""
    return F.from_json(_c(json_col), schema)
