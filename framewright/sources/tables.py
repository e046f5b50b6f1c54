"""Parquet tables of a scale-factor folder.

``load`` only declares the scan; Catalyst pushes projections and filters into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


# Schemas of the table files, read once per path.  Declaring a Parquet scan without a schema
# reads a footer on the driver to infer it (tens of milliseconds, more on object stores); with the
# remembered schema each load is still a fresh relation (its own listing and column ids, so two
# loads of one table can be joined with each other).  ``refresh`` forgets the schemas after a
# table's files change shape.
_SCHEMAS: dict[tuple[str, str], StructType] = {}


def load(spark: SparkSession, sf_dir: str, name: str, reuse: bool = True) -> DataFrame:
    path = table_path(sf_dir, name)
    if not reuse:
        return spark.read.parquet(path)
    key = (spark.conf.get("spark.app.id", ""), path)       # per application: settings may differ
    schema = _SCHEMAS.get(key)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[key] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def refresh() -> None:
    """Forget the remembered schemas (after the files of a table changed shape)."""
    _SCHEMAS.clear()


class Tables:
    """Attribute access to the tables of one folder: ``t = Tables(spark, d); t.lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return load(self.spark, self.sf_dir, name)
        raise AttributeError(name)
