"""Range frames and offsets whose groups are split along the axis (value-bounded windows, lag and lead).

A plain window sorts a whole group in one task.  Here the axis is cut into slices of a given length and a
task sorts one (group, slice): a range frame gets the overlap of the neighbouring slices by copying the points
that reach into them, an offset takes what lies before its slice from the ends of the slices before.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.operators.temporal import place

_FIRST = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def _number(df: DataFrame, at: str, size: str | int) -> int:
    """A length on the axis: microseconds for times, days for dates, else the number given."""
    if isinstance(size, str):
        micros = pd.Timedelta(size).value // 1000
        return micros // 86_400_000_000 if df.select(at).dtypes[0][1] == "date" else micros
    return size


def _same(a: DataFrame, b: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    cond = F.lit(True)
    for x, y in pairs:
        cond = cond & a[x].eqNullSafe(b[y])
    return cond


def range_frame(df: DataFrame, keys: Sequence[str], at: str, back: str | int, ahead: str | int,
                measures: dict[str, tuple[str, Column]], slice_length: str | int) -> DataFrame:
    """``df`` with measures over the rows of its group whose place is in [place - back, place + ahead].

    ``measures``: ``name -> (kind, column)``, kind ``count``, ``sum``, ``min`` or ``max``.  Rows at the same place share a
    frame and are one point; null keys are a group; a row without a place has null measures.  The result does not
    depend on ``slice_length``; slices much shorter than the frame copy every point to many of them."""
    back, ahead, width = (_number(df, at, x) for x in (back, ahead, slice_length))
    gs = [f"__g{i}" for i in range(len(keys))]
    rows = df.withColumn("__p", place(df, at))
    points = rows.where(F.col("__p").isNotNull()).groupBy(*[F.col(k).alias(g) for k, g in zip(keys, gs)], F.col("__p").alias("__q")).agg(
        *[_FIRST[kind](c).alias(f"__m{i}") for i, (kind, c) in enumerate(measures.values())])
    upto = F.sequence(F.floor((F.col("__q") - ahead) / width), F.floor((F.col("__q") + back) / width))
    points = points.withColumn("__slice", F.explode(upto))
    frame = Window.partitionBy(*gs, "__slice").orderBy("__q").rangeBetween(-back, ahead)
    found = points.select(*gs, "__q", "__slice", *[_MERGE[kind](f"__m{i}").over(frame).alias(m) for i, (m, (kind, _)) in enumerate(measures.items())])
    found = found.where(F.col("__slice") == F.floor(F.col("__q") / width))
    joined = rows.join(found, _same(rows, found, list(zip(keys, gs))) & (rows["__p"] == found["__q"]), "left")
    return joined.select(*[rows[c] for c in df.columns], *list(measures))


def shifted(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, str], offset: int, slice_length: str | int) -> DataFrame:
    """``df`` with values of the row ``offset`` places before it in its group (after it, if negative): ``columns`` maps
    new names to columns.  Null where there is no such row.

    ``order`` must order the rows of a group fully; its first column is the axis.  Null keys are a group, a null
    place comes first.  Only the last rows of each slice are sent on to later ones."""
    n, back = abs(offset), offset > 0
    if n == 0:
        raise ValueError("an offset of no rows")
    width = _number(df, order[0], slice_length)
    rows = df.withColumn("__slice", F.coalesce(F.floor(place(df, order[0]) / width), F.lit(-(1 << 62))))
    turn = (lambda c: F.col(c).asc_nulls_first()) if back else (lambda c: F.col(c).desc_nulls_last())
    group = Window.partitionBy(*keys, "__slice")
    inside = group.orderBy(*[turn(c) for c in order])
    value = F.struct(*[F.col(c).alias(m) for m, c in columns.items()])
    rows = rows.select("*", F.row_number().over(inside).cast("long").alias("__nth"), F.count(F.lit(1)).over(group).alias("__size"),
                       F.lag(value, n).over(inside).alias("__value"))
    sizes = df.withColumn("__slice", F.coalesce(F.floor(place(df, order[0]) / width), F.lit(-(1 << 62)))).groupBy(*keys, "__slice").agg(
        F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*keys).orderBy(turn("__slice")).rowsBetween(Window.unboundedPreceding, -1)
    gs = [f"__g{i}" for i in range(len(keys))]
    starts = sizes.select(*[F.col(k).alias(g) for k, g in zip(keys, gs)], F.col("__slice").alias("__s"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"))
    out = [*df.columns, *columns]
    inner = rows.where(F.col("__nth") > n).select(*df.columns, *[F.col("__value")[m].alias(m) for m in columns])
    # Only the rows at the ends of slices need their place in the whole group.
    ends = rows.where((F.col("__nth") <= n) | (F.col("__nth") > F.col("__size") - n)).withColumn("__own", value)
    ends = ends.join(starts, _same(ends, starts, [*zip(keys, gs), ("__slice", "__s")])).withColumn("__pos", F.col("__start") + F.col("__nth"))
    heads = ends.where(F.col("__nth") <= n).select(*df.columns, (F.col("__pos") - n).alias("__want"))
    tails = ends.where(F.col("__nth") > F.col("__size") - n).select(
        *[F.col(k).alias(f"__t{i}") for i, k in enumerate(keys)], F.col("__pos").alias("__at"), F.col("__own").alias("__v"))
    met = heads.join(tails, _same(heads, tails, [(k, f"__t{i}") for i, k in enumerate(keys)]) & (heads["__want"] == tails["__at"]), "left")
    return inner.unionByName(met.select(*df.columns, *[F.col("__v")[m].alias(m) for m in columns])).select(*out)
