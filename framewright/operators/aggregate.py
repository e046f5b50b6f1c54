"""Aggregations.

Every aggregate here is either algebraic (count, sum, min/max, moments, sketches) and runs as a
partial aggregate before the shuffle, so a hot group costs one row per task at the exchange, or
it is a collection aggregate (``collect_set``/``collect_list``) that is only applied where the
collected domain has a bound (distinct values of a low-cardinality column, or pre-aggregated
pairs).  Exact distinct counts plan as a two-level aggregate (deduplicate, then count), both
levels partial.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """A1: one-row frame with the row count (lazy counterpart of ``df.count()``)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def counts(df: DataFrame, column: str) -> list[Column]:
    """A1/A2/A4: all rows, non-null values, exact distinct values of one column."""
    c = F.col(column)
    return [F.count(F.lit(1)).alias("n_rows"), F.count(c).alias(f"n_{column}"),
            F.count_distinct(c).alias(f"n_distinct_{column}")]


def approx_distinct(c: Column | str, rsd: float = 0.05) -> Column:
    """A5: HyperLogLog++ distinct count with relative standard deviation ``rsd``."""
    return F.approx_count_distinct(_c(c), rsd)


def approx_quantiles(c: Column | str, probabilities: Sequence[float], accuracy: int = 10_000) -> Column:
    """An array of approximate quantiles as an aggregate expression (runs distributed;
    ``df.approxQuantile`` is the driver-side equivalent)."""
    return F.percentile_approx(_c(c), list(probabilities), accuracy)


def first_last_by(value: Column | str, order: Column | str, prefix: str) -> list[Column]:
    """The value at the smallest and at the largest ``order``: a repeatable first/last."""
    return [F.min_by(_c(value), _c(order)).alias(f"{prefix}_first"),
            F.max_by(_c(value), _c(order)).alias(f"{prefix}_last")]


def moments(x: str, y: str) -> list[Column]:
    """Mean three ways, variances, standard deviations, skewness, kurtosis (excess,
    population), correlation and covariances."""
    cx, cy = F.col(x), F.col(y)
    return [
        F.avg(cx).alias("avg_x"), F.mean(cx).alias("mean_x"),
        (F.sum(cx) / F.count(cx)).alias("sum_over_count_x"),
        F.var_pop(cx).alias("var_pop_x"), F.var_samp(cx).alias("var_samp_x"),
        F.stddev_pop(cx).alias("stddev_pop_x"), F.stddev_samp(cx).alias("stddev_samp_x"),
        F.skewness(cx).alias("skewness_x"), F.kurtosis(cx).alias("kurtosis_x"),
        F.corr(cx, cy).alias("corr_xy"), F.covar_samp(cx, cy).alias("covar_samp_xy"),
        F.covar_pop(cx, cy).alias("covar_pop_xy"),
    ]


def sorted_set(c: Column | str) -> Column:
    """Distinct values of a bounded-domain column as a sorted array (the set is merged
    map-side, so its size is bounded by the domain, not by the group's row count)."""
    return F.sort_array(F.collect_set(_c(c)))


def sorted_list_of_pairs(df: DataFrame, keys: Sequence[str], item: str, weight_name: str = "n") -> DataFrame:
    """A17 (list form): per group, the sorted list of (item, row count) pairs.  Rows are first
    pre-aggregated to one row per (group, item), so the list length is the number of distinct
    items in the group, never the group's row count."""
    pairs = df.groupBy(*keys, item).agg(F.count(F.lit(1)).alias(weight_name))
    return pairs.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(F.col(item), F.col(weight_name)))).alias(f"{item}_counts"))


def group_agg(df: DataFrame, keys: Sequence[Column | str], *aggs: Column) -> DataFrame:
    """Group by one or more keys, several aggregates in one pass."""
    return df.groupBy(*keys).agg(*aggs)


def averages_of_numeric(df: DataFrame, keys: Sequence[str], prefix: str = "avg_") -> DataFrame:
    """``avg()`` of every numeric non-key column, renamed ``avg_<column>``."""
    numeric = numeric_columns(df, keys)
    return df.groupBy(*keys).agg(*[F.avg(F.col(c)).alias(f"{prefix}{c}") for c in numeric])


def levels_of_totals(df: DataFrame, keys: Sequence[str], sets: str | Sequence[Sequence[str]], measures: Mapping[str, tuple[str, str | None]],
                     gid: str = "grouping_id") -> DataFrame:
    """A21-A24 over pre-aggregated groups: rows are aggregated by the full key first and only the
    groups are expanded to the levels of ``sets`` (``"rollup"``, ``"cube"`` or explicit sets).

    ``measures`` maps an output name to ``(kind, column)``; kinds that can be re-aggregated: ``sum``,
    ``count`` (column None: rows), ``min``, ``max`` and ``avg`` (kept as sum and count)."""
    first, again = [], []
    for i, (name, (kind, column)) in enumerate(measures.items()):
        c = F.lit(1) if column is None else F.col(column)
        if kind not in ("sum", "count", "min", "max", "avg"):
            raise ValueError(f"{kind} cannot be computed from groups")
        if kind in ("count", "avg"):
            first.append(F.count(c).alias(f"__n{i}"))
        if kind != "count":
            first.append({"sum": F.sum, "avg": F.sum, "min": F.min, "max": F.max}[kind](c).alias(f"__v{i}"))
        value = {"sum": lambda v, n: F.sum(v), "count": lambda v, n: F.sum(n), "min": lambda v, n: F.min(v),
                 "max": lambda v, n: F.max(v), "avg": lambda v, n: F.sum(v) / F.sum(n)}[kind](f"__v{i}", f"__n{i}")
        again.append((F.coalesce(value, F.lit(0)) if kind == "count" else value).alias(name))
    groups = df.groupBy(*keys).agg(*first)
    spread = {"rollup": groups.rollup, "cube": groups.cube}.get(sets) if isinstance(sets, str) else None
    leveled = spread(*keys) if spread else groups.groupingSets([list(s) for s in sets], *keys)
    return leveled.agg(*again, F.grouping_id().alias(gid))


def rollup(df: DataFrame, keys: Sequence[str], *aggs: Column, gid: str = "grouping_id") -> DataFrame:
    """Prefix subtotals with the grouping level as a column (null keys of data and of
    subtotals stay apart through ``grouping_id``)."""
    return df.rollup(*keys).agg(*aggs, F.grouping_id().alias(gid))


def cube(df: DataFrame, keys: Sequence[str], *aggs: Column, gid: str = "grouping_id") -> DataFrame:
    """All-subset subtotals with the grouping level."""
    return df.cube(*keys).agg(*aggs, F.grouping_id().alias(gid))


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], keys: Sequence[str], *aggs: Column,
                  gid: str = "grouping_id") -> DataFrame:
    """Explicit grouping sets."""
    return df.groupingSets([list(s) for s in sets], *keys).agg(*aggs, F.grouping_id().alias(gid))


def pivot(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence, agg: Column) -> DataFrame:
    """One output column per given value; passing the values avoids an extra job that
    would find them."""
    return df.groupBy(*keys).pivot(pivot_col, list(values)).agg(agg)


#: Values that a pivot may have as columns.
MAX_VALUES = 10_000


def values_of(df: DataFrame, column: str, given: Sequence | None = None, most: int = MAX_VALUES) -> list:
    """The distinct values of a pivot column in order, null first: they become column names, so
    there are as many as the result is wide.  A caller's own list must not miss any of them.  More than
    ``most`` values raise; no more than that reach the driver."""
    found = [r[0] for r in df.select(column).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values, too many to be columns")
    found.sort(key=lambda v: (v is not None, v))
    if given is None:
        return found
    missing = [v for v in found if v not in given]
    if missing:
        raise ValueError(f"{column} has values without a column: {missing}")
    return list(given)


def pivot_values(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence, agg_fn,
                 value_col: str) -> DataFrame:
    """A25 as one aggregate: one conditional aggregate per given value,
    ``agg_fn(when(pivot_col == v, value_col))``.  For aggregates that skip nulls and give null on
    no input (sum, avg, min, max) the cells equal ``pivot``'s, in one shuffle instead of two
    (Spark's pivot first aggregates by key and pivot value, then pivots by key).  A NaN value
    matches NaN rows (Spark SQL treats NaN as equal to NaN)."""
    typ = df.select(pivot_col).schema[0].dataType
    lits = [F.lit(v).cast(typ) for v in values]
    # Column names as Spark's pivot writes them: the value cast to text.  Plain values are named
    # here; others (floats, dates, timestamps) by Spark itself in one tiny local job.
    if all(v is None or isinstance(v, (str, int, bool)) for v in values):
        names = ["null" if v is None else str(v).lower() if isinstance(v, bool) else str(v) for v in values]
    else:
        names = list(df.sparkSession.range(1).select(
            *[F.coalesce(x.cast("string"), F.lit("null")) for x in lits]).first())
    cells = [agg_fn(F.when(F.col(pivot_col).eqNullSafe(x), F.col(value_col))).alias(nm) for x, nm in zip(lits, names)]
    return df.groupBy(*keys).agg(*cells)


def time_bucket(df: DataFrame, keys: Sequence[str], ts: str, size: str, *aggs: Column,
                slide: str | None = None) -> DataFrame:
    """Group by key(s) and a tumbling (or sliding) time window, output as flat
    ``window_start`` / ``window_end`` columns."""
    w = F.window(F.col(ts), size, slide) if slide else F.window(F.col(ts), size)
    out = df.groupBy(*keys, w.alias("w")).agg(*aggs)
    return out.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      *[c for c in out.columns if c not in set(keys) | {"w"}])


def summary(df: DataFrame, *cols: str) -> DataFrame:
    """Count, mean, stddev, min, max per column; every cell is a string."""
    return df.describe(*cols)


def crosstab_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """A29 (long form): count per (a, b) pair; one partial aggregate, no driver step."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, a: str, b: str, b_values: Sequence) -> DataFrame:
    """A29 (wide form): one column per given value of ``b``, zero where a pair is absent; the
    first column is named ``<a>_<b>`` like ``df.stat.crosstab``.  Values are given so no job
    collects them."""
    wide = df.groupBy(a).pivot(b, list(b_values)).agg(F.count(F.lit(1)))
    from framewright.operators.project import quoted
    return wide.select(F.col(quoted(wide.columns[0])).alias(f"{a}_{b}"),
                       *[F.coalesce(F.col(quoted(c)), F.lit(0)).alias(c) for c in wide.columns[1:]])


def frequent_items(df: DataFrame, cols: Sequence[str], support: float = 0.01) -> DataFrame:
    """Frequent items per column (may include false positives)."""
    return df.stat.freqItems(list(cols), support)


def frequent_values(df: DataFrame, column: str, support: float) -> DataFrame:
    """A30 (exact form): values whose share of rows is at least ``support``, with their count.
    A grouped count filtered against a scalar subquery for the total; no false positives."""
    grouped = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = grouped.agg(F.sum("n")).scalar()          # same grouped plan: Spark can reuse its shuffle
    threshold = F.lit(Decimal(str(support))) * total  # exact decimal, no double rounding at the boundary
    return grouped.where(F.col("n") >= threshold)


def distinct_rows(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct rows (of the given columns)."""
    return (df.select(*cols) if cols else df).distinct()


def conditional_sum(value: Column | str, *conditions: Column, name: str = "total") -> Column:
    """Sum of ``value`` once per true condition (a row may add more than once)."""
    if not conditions:
        raise ValueError("conditional_sum needs at least one condition")
    out = None
    for cond in conditions:
        term = F.sum(F.when(cond, _c(value)).otherwise(F.lit(0)))
        out = term if out is None else out + term
    return out.alias(name)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if f.name not in ex and
            f.dataType.typeName() in ("integer", "long", "short", "byte", "float", "double", "decimal")]


# Two-level sketch aggregation.  A global sketch aggregate ends in one task that merges one
# partial buffer per map task; with hundreds of thousands of map tasks and large buffers (quantile
# summaries at high accuracy) that single merge becomes the bottleneck.  These forms first merge
# the partial sketches of each bucket of map tasks (bucket = map task index modulo ``buckets``:
# each task feeds exactly one bucket, and a retried task feeds the same bucket), then merge the
# bucket sketches once.  The sketches are mergeable DataSketches (KLL for quantiles, HLL for
# distinct counts).


def _task_bucket(buckets: int) -> Column:
    return F.pmod(F.spark_partition_id(), F.lit(buckets)).alias("__bucket")


def approx_quantiles_tree(df: DataFrame, column: str, probabilities: Sequence[float], k: int = 200,
                          buckets: int = 1024, name: str = "quantiles") -> DataFrame:
    """A28 at scale: one-row frame with the approximate quantiles of ``column`` (KLL sketch with
    parameter ``k``; rank error about 1.65 / k)."""
    per_bucket = (df.select(F.col(column).cast("double").alias("__x"), _task_bucket(buckets))
                  .groupBy("__bucket").agg(F.kll_sketch_agg_double("__x", k).alias("__s")))
    merged = per_bucket.agg(F.kll_merge_agg_double("__s", k).alias("__s"))
    return merged.select(F.array(*[F.kll_sketch_get_quantile_double("__s", F.lit(float(p)))
                                   for p in probabilities]).alias(name))


def approx_distinct_tree(df: DataFrame, column: str, lg_k: int = 12, buckets: int = 1024,
                         name: str = "approx_distinct") -> DataFrame:
    """A5 at scale: one-row frame with an HLL estimate of the distinct values of ``column``
    (relative standard error about 1.04 / sqrt(2 ** lg_k))."""
    per_bucket = (df.select(F.col(column).alias("__x"), _task_bucket(buckets))
                  .groupBy("__bucket").agg(F.hll_sketch_agg("__x", lg_k).alias("__s")))
    merged = per_bucket.agg(F.hll_union_agg("__s").alias("__s"))
    return merged.select(F.hll_sketch_estimate("__s").alias(name))
