"""Sequence and local-row sources.

Local rows are for fixtures and small lookup tables whose size is known on the driver; they are
never used to move table data through the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import StructType


def number_range(spark: SparkSession, n: int, name: str = "number", start: int = 0,
                 num_partitions: int | None = None) -> DataFrame:
    """The integers ``start .. n-1`` as one long column, generated in parallel partitions."""
    return spark.range(start, n, 1, num_partitions).toDF(name)


def rows_with_schema(spark: SparkSession, rows: Sequence[Row | tuple], schema: StructType | str) -> DataFrame:
    """Rows with a declared schema (no RDD round trip)."""
    return spark.createDataFrame(list(rows), schema)


def tuples_named(spark: SparkSession, rows: Iterable[tuple], names: Sequence[str]) -> DataFrame:
    """Tuples, then names by position."""
    return spark.createDataFrame(list(rows)).toDF(*names)
