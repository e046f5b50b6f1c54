"""User-defined table functions: a table argument, partitioned and ordered, read in Arrow batches.

``value_runs`` finds the runs of equal values along a time column.  The function itself sees one
partition of the table argument, in order, batch by batch, and keeps one open run.  So that a key with a
third of all rows is read by many tasks, the time axis is cut into slices, each slice of a key is a
group of its own, and the runs at the edges of slices (two rows per key and slice) are joined
afterwards.  A partition holds many groups, one after the other: there may be as many groups as rows, and
each partition costs a call of the function and some small batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from framewright.operators.temporal import length, place


#: Partitions of the table argument, each with the groups (a slice of a key) of one hash.
BUCKETS = 4096


def runs_function(table: StructType, keys: Sequence[str], time: str, value: str):
    """The table function for tables of this schema, ordered by ``keys, time, value`` or partitioned by ``keys`` and
    ordered by the others; all rows of a key are in one partition.

    Gives one row per run: the keys, the value, ``first`` and ``last`` time, ``n`` rows, ``nth`` (from 0, within
    the key) and ``left`` (runs of the key after it: 0 for the last one, else 1)."""
    out = StructType([*(table[k] for k in keys), table[value], StructField("first", table[time].dataType),
                      StructField("last", table[time].dataType), *(StructField(x, LongType()) for x in ("n", "nth", "left"))])
    schema, names = to_arrow_schema(out), list(keys)

    def changed(column: pa.Array) -> np.ndarray:
        """Whether a value differs from the one before it (the first one: no); nulls are equal, and so are NaNs, 0.0 and -0.0."""
        if pa.types.is_floating(column.type):
            x, null = column.to_numpy(zero_copy_only=False), column.is_null().to_numpy(zero_copy_only=False)
            same = ((x[1:] == x[:-1]) | (np.isnan(x[1:]) & np.isnan(x[:-1]))) & (null[1:] == null[:-1])
        elif pa.types.is_nested(column.type):
            x = column.to_pylist()
            same = np.array([y == z for y, z in zip(x[1:], x)], dtype=bool)
        else:
            code = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            same = code[1:] == code[:-1]
        return np.r_[False, ~same]

    class Runs:
        def __init__(self):
            self.open = None

        def _closed(self, rows: dict, left: np.ndarray) -> pa.Table:
            rows = {**rows, "left": left}
            return pa.table([pa.array(c) if isinstance(c, np.ndarray) else c for c in rows.values()],
                            names=schema.names).cast(schema)

        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            if not batch.num_rows:
                return
            t = batch.column(time)
            rows = {k: batch.column(k) for k in [*names, value]} | {"first": t, "last": t}
            count, nth = np.ones(batch.num_rows, dtype=np.int64), 0
            if self.open is not None:                       # the open run goes on as the first row
                rows = {k: pa.concat_arrays([self.open[k], c]) for k, c in rows.items()}
                count, nth = np.r_[self.open["n"], count], self.open["nth"][0]
            other = np.zeros(len(count), dtype=bool)
            for k in names:
                other |= changed(rows[k])
            new = other | changed(rows[value])
            new[0] = True
            start = np.flatnonzero(new)
            at, other = np.arange(len(start)), other[start]
            end, before = np.r_[start[1:], len(count)] - 1, np.maximum.accumulate(np.where(other, at, -1))
            found = {k: c.take(pa.array(end if k == "last" else start)) for k, c in rows.items()}
            found |= {"n": np.add.reduceat(count, start), "nth": np.where(before < 0, nth + at, at - before)}
            cut = len(start) - 1
            if cut:
                yield self._closed({k: c[:cut] for k, c in found.items()}, np.where(other[1:], 0, 1))
            self.open = {k: c[cut:] for k, c in found.items()}

        def terminate(self) -> Iterator[pa.Table]:
            if self.open is not None:
                yield self._closed(self.open, np.zeros(1, dtype=np.int64))

    return F.arrow_udtf(Runs, returnType=out)


def register_runs(spark: SparkSession, name: str, df: DataFrame, keys: Sequence[str], time: str, value: str) -> str:
    """Make the table function callable from SQL for tables with the schema of ``df``; returns the name."""
    spark.udtf.register(name, runs_function(df.schema, keys, time, value))
    return name


def value_runs(df: DataFrame, keys: Sequence[str], time: str, value: str, width: str | float,
               names: tuple[str, str, str] = ("run_start", "run_end", "n_rows")) -> DataFrame:
    """``keys``, ``value`` and the first time, last time and rows of each maximal run of equal values.

    Rows of a key are in order of time (null first), then value (null first); null is a value.  ``width`` is
    the length of a slice, a number or for times text such as ``"7 days"``; it changes no result.  An empty
    table gives no rows; other columns take no part."""
    kept = [f"__k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, kept)], F.floor(place(df, time) / length(df, time, width)).alias("__slice"),
                     F.col(f"`{time}`").alias("__t"), F.col(f"`{value}`").alias("__v"))
    parts = [*kept, "__slice"]
    rows = rows.withColumn("__bucket", F.pmod(F.xxhash64(*parts), F.lit(BUCKETS)).cast("int"))
    cut = rows.asTable().partitionBy("__bucket").orderBy(*parts, "__t", "__v")
    runs = runs_function(rows.schema, parts, "__t", "__v")(cut)
    edge = (F.col("nth") == 0) | (F.col("left") == 0)
    along = Window.partitionBy(*kept).orderBy("__slice", "nth")
    before = F.lag(F.struct("__slice", "__v")).over(along)
    edges = runs.where(edge).withColumn("__before", before)
    same = F.col("__before").isNotNull() & ~F.col("__before.__slice").eqNullSafe(F.col("__slice")) & F.col("__before.__v").eqNullSafe(F.col("__v"))
    edges = edges.withColumn("__run", F.sum(F.when(same, 0).otherwise(1)).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    # Null times are in the first slice: min_by would skip them.
    joined = edges.groupBy(*kept, "__run").agg(
        F.min(F.struct("__slice", "nth", F.col("__v").alias("v"), F.col("first").alias("t"))).alias("a"),
        F.max(F.struct("__slice", "nth", F.col("last").alias("t"))).alias("z"), F.sum("n").alias("n"))
    joined = joined.select(*kept, F.col("a.v").alias("__v"), F.col("a.t").alias("first"), F.col("z.t").alias("last"), "n")
    all_ = runs.where(~edge).select(*kept, "__v", "first", "last", "n").unionByName(joined)
    return all_.select(*[F.col(n).alias(k) for n, k in zip(kept, keys)], F.col("__v").alias(value), F.col("first").alias(names[0]),
                       F.col("last").alias(names[1]), F.col("n").alias(names[2]))
