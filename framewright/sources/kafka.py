"""Kafka source and sink option builders.

The Kafka connector is not part of the base PySpark distribution; these functions build the
reader/writer and the key/value/topic projection.  Loading needs the connector package on the
cluster's classpath and a reachable broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamReader, DataStreamWriter


def kafka_reader(spark: SparkSession, bootstrap: str, subscribe: str | list[str] | None = None,
                 pattern: str | None = None, **options) -> DataStreamReader:
    """S14 one topic, S15 topic list, S16 topic pattern (``subscribePattern``)."""
    if (subscribe is None) == (pattern is None):
        raise ValueError("give exactly one of subscribe or pattern")
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
    if pattern is not None:
        reader = reader.option("subscribePattern", pattern)
    else:
        topics = subscribe if isinstance(subscribe, str) else ",".join(subscribe)
        reader = reader.option("subscribe", topics)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader


def kafka_records(df: DataFrame, value: str, key: str | None = None, topic: str | None = None) -> DataFrame:
    """The record projection a Kafka sink expects: string ``key``/``value`` and optionally ``topic``."""
    cols = [f"CAST({value} AS STRING) AS value"]
    if key is not None:
        cols.insert(0, f"CAST({key} AS STRING) AS key")
    if topic is not None:
        cols.insert(0, f"CAST({topic} AS STRING) AS topic")
    return df.selectExpr(*cols)


def kafka_writer(records: DataFrame, bootstrap: str, checkpoint_location: str,
                 topic: str | None = None) -> DataStreamWriter:
    """S17 topic from a column (``records`` holds ``topic``), S18 fixed topic option.  The
    checkpoint location (R17) must be on shared storage."""
    writer = (records.writeStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap)
              .option("checkpointLocation", checkpoint_location))
    if topic is not None:
        writer = writer.option("topic", topic)
    elif "topic" not in records.columns:
        raise ValueError("records need a topic column or a fixed topic")
    return writer
