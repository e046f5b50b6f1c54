"""File scans and writes (S1-S5), views and SQL.

All readers are lazy declarations.  Schema inference (S1, S3) runs an extra pass over the
input; pass a declared schema (S4) wherever the input is large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str | list[str], header: bool = True,
             infer_schema: bool = True, schema: StructType | str | None = None, **options) -> DataFrame:
    """CSV scan; ``path`` may be a glob such as ``dir/*.csv`` (many daily files as one table)."""
    reader = spark.read.format("csv").option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer_schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def read_json(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None,
              **options) -> DataFrame:
    """JSON-lines scan, inferred or with a declared schema (metadata is kept; file
    sources make every field nullable)."""
    reader = spark.read.format("json")
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def read_parquet(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None) -> DataFrame:
    """Parquet scan; the file carries its schema."""
    reader = spark.read.format("parquet")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
          partition_by: list[str] | None = None, **options) -> None:
    """Distributed write: every task writes its own files; nothing passes through the driver."""
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.save(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Name a frame for SQL in this session's catalog."""
    df.createOrReplaceTempView(name)
    return df


def sql(spark: SparkSession, text: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """Run SQL.  Frames passed as keywords are referenced as ``{name}`` in the text and are
    bound without touching the global catalog; ``args`` binds named parameters (``:p``)."""
    if frames:
        return spark.sql(text, args, **frames)
    return spark.sql(text, args)


def read_orc(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None,
             merge_schemas: bool = False) -> DataFrame:
    """ORC scan.  Filters reach the stripes and row groups (least and greatest values, Bloom filters), and
    only the columns read are decoded.  With a declared ``schema`` columns are found by name and missing
    ones are null; ``merge_schemas`` reads files that gained columns over time as one table."""
    reader = spark.read.format("orc").option("mergeSchema", merge_schemas)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def write_orc(df: DataFrame, path: str, sort_by: list[str] | None = None, bloom: list[str] | None = None,
              partition_by: list[str] | None = None, mode: str = "overwrite", **options) -> None:
    """ORC write that later filters can use: rows are dealt to files by ranges of ``sort_by`` and sorted within
    them, so that each stripe holds a narrow range; ``bloom`` columns get Bloom filters for equality.

    Give ``sort_by`` a last column that tells rows apart (an id) where its first one has very frequent
    values: a range boundary may then fall inside such a value."""
    if sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*(partition_by or []), *sort_by)
    if bloom:
        options = {"orc.bloom.filter.columns": ",".join(bloom), "orc.bloom.filter.fpp": 0.01} | options
    write(df, path, "orc", mode, partition_by, **options)
