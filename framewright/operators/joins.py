"""Joins (J1-J15).

Scale notes
-----------
* Spark picks broadcast-hash or sort-merge per join from size statistics, and AQE re-plans at
  run time (``spark.sql.adaptive.*``), so the plain joins carry no hints.
* Hot keys: a single key may hold a large share of either side.  AQE splits hot partitions of both
  sides of an inner join and of the left side of a semi or anti join, as long as both sides come
  straight from a shuffle by the join key; it cannot split the lookup side.  Therefore
  - semi/anti joins look up a side that was reduced to at most ``LOOKUP_ROWS`` rows per key by a
    pre-aggregate on (key, bucket of map tasks).  That aggregate's shuffle is not the join's: the
    join still shuffles both sides by its key, so AQE can split the hot left rows;
  - outer joins are built as ``inner  UNION ALL  unmatched rows``, the latter from such an anti join.
    ``skew_safe=False`` gives the single Spark join instead.
* A cross product broadcasts its right side within a checked size and otherwise leaves the plan to
  Spark; its output is what was asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.plans.broadcast import broadcast_within

#: Rows that a key keeps on the lookup side of a semi or anti join.
LOOKUP_ROWS = 16

KeyPairs = Sequence[tuple[str, str]]


def _pairs(on: str | Sequence[str] | KeyPairs) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    out = []
    for k in on:
        out.append((k, k) if isinstance(k, str) else (k[0], k[1]))
    return out


def _condition(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    cond = None
    for lk, rk in pairs:
        c = left[lk] == right[rk]
        cond = c if cond is None else cond & c
    return cond


def join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """One Spark join.  ``on`` is a name, a list of names (join by name:
    one key column remains), a list of (left, right) name pairs, or a Column condition."""
    if isinstance(on, Column):
        return left.join(right, on, how)
    pairs = _pairs(on)
    if all(lk == rk for lk, rk in pairs):
        return left.join(right, [lk for lk, _ in pairs], how)
    return left.join(right, _condition(left, right, pairs), how)


def _lookup_keys(side: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """The keys of a side, each at most ``LOOKUP_ROWS`` times; a retried task feeds the same bucket."""
    bucket = F.pmod(F.spark_partition_id(), F.lit(LOOKUP_ROWS)).alias("__bucket")
    rows = side.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], bucket)
    return rows.groupBy(*names, "__bucket").agg(F.lit(1).alias("__one")).select(*names)


def semi_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Left rows with a match, each left row once (duplicate left rows stay duplicated).
    The right side is pre-aggregated by key first (see module notes)."""
    pairs = _pairs(on)
    lks = [lk for lk, _ in pairs]
    tmp = [f"__k{i}" for i in range(len(pairs))]
    keys = _lookup_keys(right, [rk for _, rk in pairs], tmp)
    cond = _condition(left, keys, list(zip(lks, tmp)))
    return left.join(keys, cond, "left_semi")


def anti_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Left rows without a match (a null left key never matches), against pre-aggregated keys."""
    pairs = _pairs(on)
    lks = [lk for lk, _ in pairs]
    tmp = [f"__k{i}" for i in range(len(pairs))]
    keys = _lookup_keys(right, [rk for _, rk in pairs], tmp)
    cond = _condition(left, keys, list(zip(lks, tmp)))
    return left.join(keys, cond, "left_anti")


def _padded(df: DataFrame, first: list[str], other: DataFrame, other_first: bool) -> DataFrame:
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in other.schema.fields]
    own = [F.col(c) for c in first]
    return df.select(*(nulls + own if other_first else own + nulls))


def _unmatched(side: DataFrame, other: DataFrame, pairs: list[tuple[str, str]], other_first: bool) -> list[DataFrame]:
    """Rows of ``side`` without a partner in ``other``, padded with typed nulls.  Rows with a null
    key never match and skip the anti join, so the anti join reads exactly the non-null-key input
    the inner join reads and Spark can reuse that shuffle instead of repeating it."""
    keys = [F.col(k) for k, _ in pairs]
    not_null = keys[0].isNotNull()
    for k in keys[1:]:
        not_null = not_null & k.isNotNull()
    unmatched = anti_join(side.where(not_null), other, pairs)
    null_keyed = side.where(~not_null)
    return [_padded(unmatched, side.columns, other, other_first), _padded(null_keyed, side.columns, other, other_first)]


def outer_join(left: DataFrame, right: DataFrame, on: str | Sequence, how: str = "full",
               skew_safe: bool = True) -> DataFrame:
    """``how`` in ``left``, ``right``, ``full``.  Output columns are all left columns then
    all right columns; both sides must have disjoint column names (rename first, J14).

    With ``skew_safe`` the result is ``inner UNION ALL unmatched-left UNION ALL unmatched-right``;
    see the module notes."""
    how = {"left_outer": "left", "leftouter": "left", "right_outer": "right", "rightouter": "right",
           "outer": "full", "full_outer": "full", "fullouter": "full"}.get(how, how)
    if how not in ("left", "right", "full"):
        raise ValueError(f"not an outer join type: {how}")
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"rename overlapping columns before an outer join: {sorted(clash)}")
    pairs = _pairs(on)
    if not skew_safe:
        return left.join(right, _condition(left, right, pairs), how).select(*left.columns, *right.columns)
    parts = [left.join(right, _condition(left, right, pairs), "inner").select(*left.columns, *right.columns)]
    if how in ("left", "full"):
        parts += _unmatched(left, right, pairs, other_first=False)
    if how in ("right", "full"):
        parts += _unmatched(right, left, [(rk, lk) for lk, rk in pairs], other_first=True)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cross_product(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every pair of rows.  ``right`` is broadcast if its plan's size is within the bound of
    ``plans.broadcast``, so the output then grows with ``left`` without a shuffle."""
    return left.crossJoin(broadcast_within(right))


def array_member_join(left: DataFrame, array_col: str, right: DataFrame, right_key: str) -> DataFrame:
    """Rows of ``left`` paired with the rows of ``right`` whose key is an element of
    ``left[array_col]`` (inner join on ``array_contains``), as an equi join on the distinct
    exploded elements instead of a nested-loop join."""
    member = "__member"
    exploded = left.withColumn(member, F.explode(F.array_distinct(F.col(array_col))))
    out = exploded.join(right, exploded[member] == right[right_key], "inner")
    return out.drop(member)


def join_keep_both_keys(left: DataFrame, right: DataFrame, lkey: str, rkey: str,
                        left_alias: str = "l", right_alias: str = "r", how: str = "inner") -> DataFrame:
    """Both key columns kept; the sides are aliased so either key can be named later as
    ``l.key`` / ``r.key`` without an ambiguous reference."""
    l, r = left.alias(left_alias), right.alias(right_alias)
    return l.join(r, F.col(f"{left_alias}.{lkey}") == F.col(f"{right_alias}.{rkey}"), how)


def join_drop_right_key(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on an expression, then drop the right key by column reference."""
    return left.join(right, left[key] == right[key], how).drop(right[key])


def join_renamed(left: DataFrame, right: DataFrame, lkey: str, rkey: str, how: str = "inner") -> DataFrame:
    """Rename the right key to the left key's name, then join by name (one key column)."""
    return left.join(right.withColumnRenamed(rkey, lkey), lkey, how)
