"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame`` and, where the
query is SQL-expressible, the equivalent DuckDB SQL over the same Parquet tables.

Every registered query reads the full tables of the folder it is given.  Column names of the
Spark result and of the SQL result are identical (every computed column is aliased).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    oracle: str | None
    covers: tuple[str, ...] = field(default_factory=tuple)


REGISTRY: dict[str, Query] = {}


def register(name: str, oracle: str | None = None, covers: tuple[str, ...] = ()):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, oracle.strip() if oracle else None, tuple(covers))
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the modules fills the registry.
    from framewright.plans import (  # noqa: F401
        q_relational, q_aggregates, q_scalars, q_nested, q_streams, q_features, q_formats, q_temporal, q_custom,
    )
    return REGISTRY
