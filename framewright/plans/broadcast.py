"""Size-checked broadcasting.

Spark broadcasts a join side whose estimated size is under ``spark.sql.autoBroadcastJoinThreshold``
(and AQE checks the real size again at run time), so most joins carry no hint at all.  A hint is
given only to a side whose size in bytes, as Spark's statistics or its own rows show it, is within a
bound; beyond it the plan is left to Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BYTES = 32 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Spark's size estimate of a plan: an upper estimate for scans, filters and projections."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_within(df: DataFrame, limit: int = MAX_BYTES) -> DataFrame:
    """``F.broadcast(df)`` when its estimated size is at most ``limit`` bytes, else ``df`` unchanged."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df
