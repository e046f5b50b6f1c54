"""Helpers shared by the operators: words, stored tables, size-checked broadcasts, typed batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.session import drop_dir, shared_dir
from framewright.sources.tables import load

#: A word in Python and in Java regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
WORDS = re.compile(WORD)

#: A broadcast table may have this many bytes; larger ones are joined by a shuffle.
BROADCAST_BYTES = 32 << 20

#: Stands for a null doc_id inside operators: after every other id.
LAST_ID = (1 << 63) - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` (long), ``text`` (null: empty) and the named columns, nothing else."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       F.coalesce(docs["text"], F.lit("")).alias("text"), *[docs[c] for c in more])


def words(text: Column) -> Column:
    """Array of the words of a text column."""
    return F.array_remove(F.split(text, GAP), "")


def n_words(text: Column) -> Column:
    """Number of words as long; null or blank text has none."""
    return F.coalesce(F.size(words(F.coalesce(text, F.lit("")))), F.lit(0)).cast("long")


#: With this setting Spark deletes an execution's shuffle files when the execution ends.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Folders of the stored tables of this process, oldest first.
_FOLDERS: list[str] = []


def stored(df: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: the lineage ends here, and the shuffle
    files that the write needed go when it has ended."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)
    _FOLDERS.append(path)
    return spark.read.schema(df.schema).parquet(path)


def _under(paths: list[str], folder: str) -> bool:
    inside = "/" + folder.split(":", 1)[-1].strip("/") + "/"
    return any(inside in "/" + p.split(":", 1)[-1].lstrip("/") for p in paths)


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for t in tables:
        files = t.inputFiles()
        for folder in [f for f in _FOLDERS if _under(files, f)]:
            drop_dir(t.sparkSession, folder)
            _FOLDERS.remove(folder)


def stored_since(mark: int) -> list[str]:
    """Folders of the tables stored after ``mark`` (a length of this list before)."""
    return _FOLDERS[mark:]


def stored_count() -> int:
    return len(_FOLDERS)


def release(folders: list[str], docs: DataFrame) -> list[str]:
    """Delete folders of stored tables, but for those that ``docs`` reads; returns the ones left."""
    files = docs.inputFiles() if folders else []
    left = [f for f in folders if _under(files, f)]
    for f in folders:
        if f not in left:
            drop_dir(docs.sparkSession, f)
            if f in _FOLDERS:
                _FOLDERS.remove(f)
    return left


def broadcast_within(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A broadcast hint if a stored table of fixed row width fits in ``limit`` bytes; beyond it the
    table is left as it is and Spark joins by a shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``fn`` to each Arrow batch inside the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fn(batch)
    return df.mapInArrow(run, schema)
