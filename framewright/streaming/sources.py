"""Streaming file sources (S12, S13, R13, R15) and the borrowed schema.

A stream reads a *directory*; ``glob`` narrows it to some files.  Without a limit all files that
are there make one parallel micro-batch.  ``max_files_per_trigger`` (R13) limits each batch, files
taken in modification-time order; the watermark then moves between batches, so rows of a later file
may be late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def schema_of(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> StructType:
    """The schema of a static read over the same files (the stream borrows it)."""
    reader = spark.read.format(fmt)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path).schema


def file_stream(spark: SparkSession, directory: str, fmt: str, schema: StructType | str,
                glob: str | None = None, max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """S12 (CSV), S13 (JSON), Parquet: an unbounded table over the files of ``directory``."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.load(directory)
    assert df.isStreaming  # R15
    return df


def table_stream(spark: SparkSession, sf_dir: str, table: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream over one table of a scale-factor folder, be it a file or a folder of part files; the
    schema comes from a static read."""
    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    # A pattern that only the table's own name matches: a stream's plain path must be a folder, a
    # pattern may name a file as well.
    pattern = f"{sf_dir.rstrip('/')}/[{table[0]}]{table[1:]}.parquet"
    return file_stream(spark, pattern, "parquet", schema_of(spark, path), max_files_per_trigger=max_files_per_trigger)
