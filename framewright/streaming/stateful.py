"""Per-key state functions and late rows (streams beyond windowed aggregates).

``keyed_visits`` keeps a small state for each key (its open visits) and emits a visit when the watermark
has passed its end, by an event-time timeout.  ``route_late`` splits a stream at its watermark: rows behind
it go to a side output instead of being dropped.

Scale notes
-----------
* State is keyed and spread over the shuffle partitions; a key's state holds only visits that are
  still open, so it is bounded by the watermark's delay and not by the key's rows.  A hot key's rows of a
  batch reach the function in Arrow batches and are merged one batch at a time.
* Both are replayable: state comes back from the checkpoint, and a repeated batch writes the same folder.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from framewright.functions.dates import from_epoch_micros
from framewright.operators.temporal import place
from framewright.session import shared_dir
from framewright.streaming.operators import event_time
from framewright.streaming.sinks import drain, finished_batches, start_batches


def _merged(open_: list[list[int]], places: np.ndarray, gap: int) -> list[list[int]]:
    """Open visits ``[first, last, rows]`` with more rows (in any order) merged into them."""
    items = sorted([*open_, *([int(p), int(p), 1] for p in places)])
    out: list[list[int]] = []
    for first, last, n in items:
        if out and first - out[-1][1] <= gap:
            out[-1][1], out[-1][2] = max(out[-1][1], last), out[-1][2] + n
        else:
            out.append([first, last, n])
    return out


def keyed_visits(df: DataFrame, key: str, ts: str, gap_seconds: int, watermark: str) -> DataFrame:
    """Visits of a key, runs of rows at most ``gap_seconds`` apart: ``key, first_ts, last_ts, n_rows``, each
    emitted once, when the watermark is past its last row plus the gap (append mode).

    The state of a key is the list of its open visits; rows may arrive in any order within the watermark
    and join two open visits into one.  Rows without a time are left out, null keys are a key.  Visits that
    are still open when the stream ends stay in the state and go on when it is started again."""
    gap = gap_seconds * 1_000_000
    key_type = df.schema[key].dataType.simpleString()
    rows = event_time(df.where(F.col(ts).isNotNull()), ts, "__et").withWatermark("__et", watermark)
    rows = rows.select(key, "__et", place(df, ts).alias("__p"))

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        open_ = [list(map(int, v)) for v in zip(*state.get)] if state.exists else []
        for frame in frames:
            open_ = _merged(open_, frame["__p"].to_numpy(), gap)
        now = state.getCurrentWatermarkMs() * 1000
        closed = [v for v in open_ if v[1] + gap <= now]
        open_ = [v for v in open_ if v[1] + gap > now]
        if open_:
            state.update(tuple(list(c) for c in zip(*open_)))
            due = min(v[1] for v in open_) + gap
            state.setTimeoutTimestamp(max(due // 1000, now // 1000 + 1))
        elif state.exists:
            state.remove()
        if closed:
            first, last, n = zip(*closed)
            yield pd.DataFrame({"k": [k[0]] * len(closed), "first": first, "last": last, "n_rows": n})

    out = rows.groupBy(key).applyInPandasWithState(
        step, f"k {key_type}, first long, last long, n_rows long", "first array<long>, last array<long>, n array<long>",
        "append", GroupStateTimeout.EventTimeTimeout)
    return out.select(F.col("k").alias(key), from_epoch_micros(F.col("first")).alias("first_ts"),
                      from_epoch_micros(F.col("last")).alias("last_ts"), "n_rows")


def _highest_before(spark: SparkSession, ledger: str, batch_id: int) -> int | None:
    """The greatest place that the batches before this one have seen."""
    paths = [p for n, p in finished_batches(spark, ledger) if n < batch_id]
    if not paths:
        return None
    return spark.read.schema("top long").parquet(*paths).agg(F.max("top")).first()[0]


def route_late(df: DataFrame, ts: str, delay_seconds: int, name: str, out_dir: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Drain a stream into two outputs: ``(on_time, late)``, both with the stream's columns and ``batch``.

    A row is late if its time is more than ``delay_seconds`` before the greatest time of all earlier
    batches (the watermark at the start of its batch).  Rows without a time are on time.  Together the outputs
    are the input, row for row.  A batch is written once, split by lateness; its greatest time goes to a
    ledger beside it, so a replayed batch is judged by the same watermark."""
    spark = df.sparkSession
    base = out_dir or shared_dir(spark, name)
    data, ledger = os.path.join(base, "data"), os.path.join(base, "ledger")

    def publish(batch: DataFrame, batch_id: int) -> None:
        top = _highest_before(spark, ledger, batch_id)
        p = place(batch, ts)
        behind = F.lit(False) if top is None else F.coalesce(p < top - delay_seconds * 1_000_000, F.lit(False))
        seen = Observation()
        marked = batch.withColumn("late", behind).observe(seen, F.max(p).alias("top"))
        marked.write.mode("overwrite").partitionBy("late").parquet(os.path.join(data, f"batch={batch_id}"))
        spark.createDataFrame([(seen.get["top"],)], "top long").coalesce(1).write.mode("overwrite").parquet(
            os.path.join(ledger, f"batch={batch_id}"))

    drain(start_batches(df, "append", name, base, publish), name)
    paths = [p for _, p in finished_batches(spark, data)]
    schema = StructType([*df.schema.fields, StructField("batch", LongType()), StructField("late", BooleanType())])
    both = spark.read.schema(schema).option("basePath", data).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return both.where("NOT late").drop("late"), both.where("late").drop("late")
