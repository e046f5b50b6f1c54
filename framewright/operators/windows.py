"""Window functions.

``ranked_report`` is the scale form of the reference's ranked purchase report: instead of
sorting every row of a partition group in one task (a hot group would put a third of the table
into one window task), rows are first pre-aggregated to one row per (group, value) with a count.
Ranks over a descending order only depend on those counts:

* ``rank``       = 1 + number of rows in the group with a larger value,
* ``dense_rank`` = position of the value among the group's distinct values,
* running ``max`` of the ordering column from the first row = the group maximum,

so the window runs over distinct values only and the per-row result is a join back on
(group, value), which AQE can split when a key is hot.  A group with very many distinct values is
split once more: its values are dealt to ``SLICES`` slices in order of value, ranks are counted inside
a slice and shifted by the totals of the slices before it.  ``ranked_report_window`` is the direct
single-window form, used by tests as the reference semantics.

Only groups of many rows need that: ``ranked_report(method="hot")`` finds them by a small aggregate, ranks
them in slices, and gives all others to the direct form, one shuffle of the rows and one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from framewright.plans.broadcast import estimated_bytes


def running_spec(keys: Sequence[str], order: str, descending: bool = True) -> WindowSpec:
    """Partition by keys, order (descending by default), rows from the start to the current row."""
    o = F.col(order).desc() if descending else F.col(order).asc()
    return Window.partitionBy(*keys).orderBy(o).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def running_max(c: str, spec: WindowSpec) -> Column:
    """W2."""
    return F.max(F.col(c)).over(spec)


def dense_rank(spec: WindowSpec) -> Column:
    """Ranks without gaps (ranking functions ignore the frame)."""
    return F.dense_rank().over(spec)


def rank(spec: WindowSpec) -> Column:
    """Ranks with gaps."""
    return F.rank().over(spec)


def ranked_report_window(df: DataFrame, keys: Sequence[str], value: str,
                         names: tuple[str, str, str] = ("max_value", "dense_rank", "rank")) -> DataFrame:
    """W5, direct form: the three window columns over one window specification."""
    spec = running_spec(keys, value)
    return df.select("*", running_max(value, spec).alias(names[0]), dense_rank(spec).alias(names[1]),
                     rank(spec).alias(names[2]))


def _join_back(df: DataFrame, ranks: DataFrame, keys: Sequence[str], value: str, names) -> DataFrame:
    cond = df[value].eqNullSafe(ranks["__v"])
    for i, k in enumerate(keys):
        cond = cond & df[k].eqNullSafe(ranks[f"__g{i}"])
    out = df.join(ranks, cond, "inner")
    return out.select(*[df[c] for c in df.columns], *[F.col(x) for x in names])


#: Slices of a group's values.
SLICES = 64


def _numeric(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")


def _from_slices(counts: DataFrame, keys: Sequence[str], value: str, names) -> DataFrame:
    """Ranks of the counts with each group's values split into slices by their place between the
    group's least and largest value (numbers; other types have one slice)."""
    n, gs = "__n", [f"__g{i}" for i in range(len(keys))]
    rows = counts.select(*[F.col(k).alias(g) for k, g in zip(keys, gs)], F.col(value).alias("__v"), n)
    if _numeric(counts, value):
        x = F.col("__v").cast("double")
        x = F.when(F.isnan(x) | x.isNull(), None).otherwise(x)
        ends = rows.groupBy(*gs).agg(F.min(x).alias("__lo"), F.max(x).alias("__hi")).select(*[F.col(g).alias(f"e{g}") for g in gs], "__lo", "__hi")
        cond = F.lit(True)
        for g in gs:
            cond = cond & F.col(g).eqNullSafe(F.col(f"e{g}"))
        rows = rows.join(ends, cond).drop(*[f"e{g}" for g in gs])
        width = F.col("__hi") - F.col("__lo")
        place = F.when((width > 0) & (width < float("inf")), F.floor((x - F.col("__lo")) / width * (SLICES - 1))).otherwise(0)
        place = F.coalesce(place, F.lit(0)).cast("int")
        # NaN is larger than every number, null comes last in descending order.
        rows = rows.withColumn("__s", F.when(F.col("__v").isNull(), -1).when(F.isnan(F.col("__v").cast("double")), SLICES).otherwise(place))
    else:
        rows = rows.withColumn("__s", F.lit(0))
    totals = rows.groupBy(*gs, "__s").agg(F.sum(n).alias("__sn"), F.count(F.lit(1)).alias("__sd"), F.max("__v").alias("__sm"))
    above = Window.partitionBy(*gs).orderBy(F.col("__s").desc())
    before = above.rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(*[F.col(g).alias(f"t{g}") for g in gs], F.col("__s").alias("__ts"),
                           F.coalesce(F.sum("__sn").over(before), F.lit(0)).alias("__off_n"),
                           F.coalesce(F.sum("__sd").over(before), F.lit(0)).alias("__off_d"),
                           F.max("__sm").over(above.rowsBetween(Window.unboundedPreceding, 0)).alias(names[0]))
    inside = Window.partitionBy(*gs, "__s").orderBy(F.col("__v").desc())
    rows = rows.withColumn("__before", F.coalesce(F.sum(n).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.withColumn("__nth", F.sum(F.lit(1).cast("long")).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    cond = F.col("__s") == F.col("__ts")
    for g in gs:
        cond = cond & F.col(g).eqNullSafe(F.col(f"t{g}"))
    return rows.join(shifts, cond).select(*gs, "__v", names[0], (F.col("__off_d") + F.col("__nth")).alias(names[1]),
                                          (F.col("__off_n") + F.col("__before") + 1).alias(names[2]))


#: Rows from which a group is hot, and the most groups that are.  The list of hot groups is broadcast, so
#: it is bounded by its length; a group that is not among the largest has at most rows / HOT_GROUPS rows.
HOT_ROWS, HOT_GROUPS = 1_000_000, 10_000

#: Buckets of groups that are counted first: one per HOT_ROWS bytes of the table, within these bounds.
BUCKETS = (1 << 10, 1 << 20)


def _hot_apart(df: DataFrame, keys: Sequence[str], value: str, names, hot_rows: int, hot_groups: int) -> DataFrame:
    """Hot groups by slices, the others by one window over their rows.

    Rows are first counted by a few hash buckets of their keys, which pre-aggregates to almost nothing; where no
    bucket is full no group can be hot, else only the rows of full buckets are counted by group."""
    buckets = min(max(estimated_bytes(df) // max(hot_rows, 1), BUCKETS[0]), BUCKETS[1])
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("__b")
    full = df.groupBy(bucket).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= hot_rows).select("__b")
    others = df
    if not full.isEmpty():
        some = df.select(*keys, bucket).join(F.broadcast(full), "__b", "left_semi")
        sizes = some.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= hot_rows)
        largest = sizes.orderBy(F.desc("__n"), *keys).limit(hot_groups)
        hot = F.broadcast(largest.select(*[F.col(k).alias(f"__h{i}") for i, k in enumerate(keys)]))
        cond = F.lit(True)
        for i, k in enumerate(keys):
            cond = cond & F.col(k).eqNullSafe(F.col(f"__h{i}"))
        others = df.join(hot, cond, "left_anti")
    ranked = ranked_report_window(others, keys, value, names).withColumns({n: F.col(n).cast("long") for n in names[1:]})
    if others is df:
        return ranked
    return ranked.unionByName(ranked_report(df.join(hot, cond, "left_semi"), keys, value, names))


def ranked_report(df: DataFrame, keys: Sequence[str], value: str,
                  names: tuple[str, str, str] = ("max_value", "dense_rank", "rank"),
                  method: str = "slices", partitions: int | None = None,
                  hot_rows: int = HOT_ROWS, hot_groups: int = HOT_GROUPS) -> DataFrame:
    """W5, skew-safe form (see module notes); same rows and values as ``ranked_report_window``, with
    64-bit ranks.

    ``method="slices"`` (one lazy plan) splits every group's values into slices; ``method="counts"``
    ranks the (group, value) counts with one window per group, for columns with few values;
    ``method="range"`` range-partitions the counts on (group, value), freezes each count's partition by
    a checkpoint in the shared folder, and shifts ranks by the totals of earlier partitions, for values
    of any type and any distribution; ``method="hot"`` does ``slices`` for the largest
    ``hot_groups`` groups of ``hot_rows`` rows or more and one window for the rest; it counts rows by hash
    bucket when called."""
    n = "__n"
    if method == "hot":
        return _hot_apart(df, keys, value, names, hot_rows, hot_groups)
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias(n))
    gcols = [F.col(k).alias(f"__g{i}") for i, k in enumerate(keys)]
    if method == "slices":
        return _join_back(df, _from_slices(counts, keys, value, names), keys, value, names)
    if method == "counts":
        by_value = Window.partitionBy(*keys).orderBy(F.col(value).desc())
        before = by_value.rowsBetween(Window.unboundedPreceding, -1)
        # All three functions share one partitioning and ordering: one sort of the counts.
        ranks = counts.select(
            *gcols, F.col(value).alias("__v"),
            F.max(F.col(value)).over(by_value.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(names[0]),
            F.sum(F.lit(1).cast("long")).over(by_value.rowsBetween(Window.unboundedPreceding, 0)).alias(names[1]),
            (F.coalesce(F.sum(F.col(n)).over(before), F.lit(0)) + 1).alias(names[2]),
        )
        return _join_back(df, ranks, keys, value, names)
    if method != "range":
        raise ValueError(f"unknown method {method}")
    from framewright.session import checkpoint_root
    checkpoint_root(df.sparkSession)                     # the shared folder (set only when unset)
    p = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = counts.repartitionByRange(p, *[F.col(k).asc() for k in keys], F.col(value).desc())
    tagged = ranged.withColumn("__pid", F.spark_partition_id()).checkpoint(eager=True)
    # Per (group, partition): rows, distinct values and the largest value; then each group's
    # offsets from its earlier partitions (a group spans at most ``p`` partitions).
    totals = tagged.groupBy(*keys, "__pid").agg(F.sum(n).alias("__bn"), F.count(F.lit(1)).alias("__bd"),
                                                F.max(value).alias("__bmax"))
    earlier = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "__pid", F.coalesce(F.sum("__bn").over(earlier), F.lit(0)).alias("__off_n"),
        F.coalesce(F.sum("__bd").over(earlier), F.lit(0)).alias("__off_d"),
        F.max("__bmax").over(Window.partitionBy(*keys)).alias(names[0]))
    local_spec = Window.partitionBy("__pid", *keys).orderBy(F.col(value).desc())
    local = tagged.select(
        *keys, "__pid", value,
        F.coalesce(F.sum(n).over(local_spec.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
        F.sum(F.lit(1).cast("long")).over(local_spec.rowsBetween(Window.unboundedPreceding, 0)).alias("__local_dense"))
    cond = local["__pid"] == offsets["__pid"]
    for k in keys:
        cond = cond & local[k].eqNullSafe(offsets[k])
    ranks = local.join(offsets, cond, "inner").select(
        *[local[k].alias(f"__g{i}") for i, k in enumerate(keys)], local[value].alias("__v"), offsets[names[0]],
        (offsets["__off_d"] + local["__local_dense"]).alias(names[1]),
        (offsets["__off_n"] + local["__before"] + 1).alias(names[2]))
    return _join_back(df, ranks, keys, value, names)
