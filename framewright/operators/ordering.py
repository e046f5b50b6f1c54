"""Sorting, limits, sampling and partitioning.

Limits always follow a total order (ties broken by further keys), so ``orderBy().limit(k)``
plans as a top-k (``TakeOrderedAndProject``: a bounded heap per task, k rows per task shuffled).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def sort(df: DataFrame, *cols: Column | str) -> DataFrame:
    """O1/O2: global sort (range-partitioned); use ``F.desc``/``Column.desc`` for descending."""
    return df.orderBy(*cols)


def sort_within_partitions(df: DataFrame, *cols: Column | str) -> DataFrame:
    """Sort each partition, no global order, no shuffle."""
    return df.sortWithinPartitions(*cols)


def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """First ``k`` rows under a total order."""
    return df.orderBy(*order).limit(k)


def sample(df: DataFrame, fraction: float, seed: int, with_replacement: bool = False) -> DataFrame:
    """Bernoulli (or Poisson with replacement) sample; repeatable for a seed and the same
    input partitioning."""
    return df.sample(withReplacement=with_replacement, fraction=fraction, seed=seed)


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Disjoint parts covering the input; repeatable for a seed and the same partitioning."""
    return df.randomSplit(list(weights), seed)


def repartition(df: DataFrame, n: int | None = None, *keys: str) -> DataFrame:
    """Hash exchange by number, by key, or both."""
    if n is None:
        return df.repartition(*keys)
    return df.repartition(n, *keys)


def coalesce(df: DataFrame, n: int) -> DataFrame:
    """Fewer partitions without a shuffle."""
    return df.coalesce(n)


def cached(df: DataFrame) -> DataFrame:
    """Mark for caching (memory, spilling to disk).  The caller unpersists; operators in
    this library never cache on their own."""
    return df.cache()
