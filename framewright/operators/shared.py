"""Replacements for broadcast variables and accumulators.

* X3 (dictionary lookup with a default): the dictionary becomes a small frame that is broadcast
  if its size is within a bound; missing words take the
  default.  No Python runs per row.
* X4 (accumulator adding a value when either of two conditions holds): one aggregate of two
  conditional sums, exact and repeatable, unlike an accumulator updated in ``foreach`` (which may
  double-count on task retries).  ``observed`` attaches the same total as a side metric to a
  frame that is being written anyway (``DataFrame.observe``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from framewright.plans.broadcast import broadcast_within


def lookup_with_default(spark: SparkSession, df: DataFrame, key: str, mapping: Mapping[str, int],
                        default: int = 0, value_name: str = "value") -> DataFrame:
    """Every row of ``df`` with ``mapping.get(row[key], default)``."""
    schema = StructType([StructField("__key", StringType(), False), StructField(value_name, LongType(), False)])
    table = spark.createDataFrame([(k, int(v)) for k, v in mapping.items()], schema)
    table = broadcast_within(table)
    out = df.join(table, df[key] == table["__key"], "left")
    return out.select(*[df[c] for c in df.columns],
                      F.coalesce(table[value_name], F.lit(default).cast("long")).alias(value_name))


def two_sided_total(df: DataFrame, side_a: str, side_b: str, value: str, entity: str = "entity",
                    total: str = "total") -> DataFrame:
    """X4 for every entity at once: per entity, the sum of ``value`` over rows where it appears
    as ``side_a`` plus the sum over rows where it appears as ``side_b`` (a row naming the entity on
    both sides counts twice).  Pre-aggregated per (a, b) pair before the two roles are unpivoted."""
    pairs = df.groupBy(side_a, side_b).agg(F.sum(F.col(value)).alias("__v"))
    roles = pairs.select(F.expr(f"stack(2, {side_a}, __v, {side_b}, __v) AS ({entity}, __v)"))
    return roles.groupBy(entity).agg(F.sum("__v").alias(total))


def two_sided_total_for(df: DataFrame, side_a: str, side_b: str, value: str, who) -> DataFrame:
    """X4 for one entity, as in the reference's accumulator: one-row frame."""
    return df.agg((F.sum(F.when(F.col(side_a) == who, F.col(value)).otherwise(0))
                   + F.sum(F.when(F.col(side_b) == who, F.col(value)).otherwise(0))).alias("total"))


def observed(df: DataFrame, name: str, *metrics: Column) -> tuple[DataFrame, Observation]:
    """Side metrics computed while ``df`` is consumed by its own action; read
    ``observation.get`` after that action."""
    obs = Observation(name)
    return df.observe(obs, *metrics), obs
