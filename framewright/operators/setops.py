"""Set operations (U1), and intersections and differences of rows, distinct and with repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*frames: DataFrame, by_name: bool = True) -> DataFrame:
    """Concatenate frames without a shuffle.  ``by_name`` matches columns by name (the safer
    form); ``by_name=False`` matches by position like ``union``."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f) if by_name else out.union(f)
    return out


#: Copies of a row made by one step of a replication.
_COPIES = 1 << 16


def _counted(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every different row ``__row`` with its number on either side, by one aggregate (columns by position;
    nulls are equal).

    The key is one struct, which no result has as a column: results of several operations on the same
    sides, which share the shuffle of this aggregate, are then united task beside task.  With the columns as keys
    Spark unites them partition by partition, so that one task reads the shuffle once for each operation."""
    if len(left.columns) != len(right.columns):
        raise ValueError("set operations need equally many columns")
    names = [f"__c{i}" for i in range(len(left.columns))]
    a, b = (df.toDF(*names).select(*names, F.lit(x).alias("__l"), F.lit(1 - x).alias("__r")) for df, x in ((left, 1), (right, 0)))
    rows = a.union(b).select(F.struct(*names).alias("__row"), "__l", "__r")
    return rows.groupBy("__row").agg(F.sum("__l").alias("__l"), F.sum("__r").alias("__r"))


def _copied(rows: DataFrame, n) -> DataFrame:
    """Each row ``n`` times, in steps, so that no row becomes one long array."""
    steps = rows.withColumn("__n", n).where("__n > 0").withColumn("__k", F.explode(F.sequence(F.lit(0), F.floor((F.col("__n") - 1) / _COPIES))))
    size = F.least(F.lit(_COPIES), F.col("__n") - F.col("__k") * _COPIES)
    return steps.withColumn("__j", F.explode(F.sequence(F.lit(1).cast("long"), size.cast("long"))))


def _named(rows: DataFrame, left: DataFrame) -> DataFrame:
    return rows.select(*[F.col("__row")[f"__c{i}"].alias(c) for i, c in enumerate(left.columns)])


def intersect(left: DataFrame, right: DataFrame, all_: bool = False) -> DataFrame:
    """Rows on both sides, once each; with ``all_`` as often as on the side that has fewer."""
    rows = _counted(left, right)
    return _named(_copied(rows, F.least("__l", "__r")) if all_ else rows.where("__l > 0 AND __r > 0"), left)


def except_(left: DataFrame, right: DataFrame, all_: bool = False) -> DataFrame:
    """Left rows that the right side does not have, once each; with ``all_`` as often as the left has more."""
    rows = _counted(left, right)
    return _named(_copied(rows, F.col("__l") - F.col("__r")) if all_ else rows.where("__l > 0 AND __r = 0"), left)
