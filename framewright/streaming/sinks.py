"""Running a streaming query to a readable result table.

``run_to_table`` starts the query, waits until it has consumed everything available
(``availableNow`` trigger; files-per-trigger limits still apply, so several micro-batches run),
and returns an ordinary frame over the result, registered as a temporary view under the query
name so SQL can read it.

Sinks:

* ``files`` (default): results are written by the executors as Parquet under the shared
  checkpoint folder, with the query's checkpoint beside them, so a lost executor or a restarted
  driver resumes from the last committed batch.  Append mode uses the fault-tolerant file sink;
  complete mode writes each batch's result to a folder of its own, and the last finished one is the
  result, so a failure never leaves half a result (a replayed batch rewrites its own folder).
* ``memory``: the result rows are held by the driver.  Only for results with a known small bound.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from framewright.session import drop_dir, shared_dir


def unique_name(base: str) -> str:
    """Query names must be unique among active queries of a session (Q16)."""
    return f"{base}_{uuid.uuid4().hex[:8]}"


def _folders(spark: SparkSession, path: str) -> list:
    """The entries of a folder, as Hadoop paths; none if it does not exist."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return [f.getPath() for f in fs.listStatus(root)] if fs.exists(root) else []


def finished_batches(spark: SparkSession, data: str) -> list[tuple[int, str]]:
    """Batches whose folder ``batch=N`` was written to its end: number and folder, oldest first."""
    found = [p for p in _folders(spark, data) if p.getName().startswith("batch=")]
    return sorted((int(p.getName().partition("=")[2]), p.toString()) for p in found
                  if any(x.getName() == "_SUCCESS" for x in _folders(spark, p.toString())))


def committed_batches(spark: SparkSession, base: str) -> int:
    """Batches that a query with its checkpoint under ``base`` has committed, in all its runs.

    A query over an empty input reports progress but commits nothing, so this and not the progress says
    whether there is a result."""
    names = [p.getName() for p in _folders(spark, os.path.join(base, "_checkpoint", "commits"))]
    return sum(1 for n in names if n.isdigit())


def start_batches(df: DataFrame, mode: str, name: str, base: str, publish: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Start a query that hands each batch to ``publish``, with its checkpoint under ``base``, and stops
    when all that is there is read."""
    writer = df.writeStream.queryName(name).outputMode(mode).trigger(availableNow=True)
    return writer.option("checkpointLocation", os.path.join(base, "_checkpoint")).foreachBatch(publish).start()


def drain(q: StreamingQuery, name: str, timeout: float | None = None) -> None:
    """Wait for the end of a query; an error of the query raises here."""
    try:
        if q.awaitTermination(timeout) is False:
            raise TimeoutError(f"streaming query {name} did not finish in {timeout}s")
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def start(df: DataFrame, mode: str, name: str, spark: SparkSession, sink: str = "files",
          processing_time: str | None = None, out_dir: str | None = None) -> tuple[StreamingQuery, str | None]:
    """Start the query; ``processing_time`` (e.g. ``"5 seconds"``, R11) gives a fixed-interval
    trigger, otherwise the query drains what is available and stops (R12)."""
    if not df.isStreaming:
        raise ValueError("not a streaming frame")
    writer = df.writeStream.queryName(name).outputMode(mode)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    if sink == "memory":
        return writer.format("memory").start(), None
    if sink != "files":
        raise ValueError(f"unknown sink {sink}")
    base = out_dir or shared_dir(spark, name)
    data, chk = os.path.join(base, "data"), os.path.join(base, "_checkpoint")
    writer = writer.option("checkpointLocation", chk)
    if mode == "append":
        q = writer.format("parquet").option("path", data).start()
    elif mode == "complete":
        def publish(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(os.path.join(data, f"batch={batch_id}"))
            for number, folder in finished_batches(spark, data)[:-1]:
                if number < batch_id:
                    drop_dir(spark, folder)         # superseded
        q = writer.foreachBatch(publish).start()
    else:
        raise ValueError("files sink supports append and complete modes; use memory for update")
    return q, data


def read_result(df: DataFrame, mode: str, data: str, spark: SparkSession, any_batch: bool) -> DataFrame:
    """The result of a files-sink query with the stream's schema."""
    if mode == "complete":
        finished = finished_batches(spark, data)
        if not finished and any_batch:
            raise RuntimeError(f"no finished result under {data}")
        return spark.read.schema(df.schema).parquet(finished[-1][1]) if finished else spark.createDataFrame([], df.schema)
    # With the schema given, a committed output without data files (no input, or every window
    # still open) reads as empty, and so does a folder that no batch ever created.
    try:
        return spark.read.schema(df.schema).parquet(data)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND" or any_batch:
            raise                      # a batch ran, so its result must be readable
        return spark.createDataFrame([], df.schema)


def run_to_table(df: DataFrame, mode: str, name: str, spark: SparkSession, sink: str = "files",
                 timeout: float | None = None, out_dir: str | None = None, source: DataFrame | None = None) -> DataFrame:
    """Drain the stream into its sink and return the result as a batch frame.

    There is no time limit unless the caller gives one.  With ``source``, a static read of the
    stream's input, a stream that ran no batch although its input has rows raises."""
    q, data = start(df, mode, name, spark, sink=sink, out_dir=out_dir)
    drain(q, name, timeout)
    if sink == "memory":
        return spark.table(name)
    any_batch = committed_batches(spark, os.path.dirname(data)) > 0
    if source is not None and not any_batch and not source.isEmpty():
        raise RuntimeError(f"streaming query {name} read nothing although its input has rows")
    result = read_result(df, mode, data, spark, any_batch)
    result.createOrReplaceTempView(name)
    return result
