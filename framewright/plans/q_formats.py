"""Queries over file formats: a table is written by the executors as CSV, JSON or ORC into the shared
checkpoint folder and scanned back, so the work grows with the table."""

from __future__ import annotations

import os

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from framewright.plans.catalog import register
from framewright.session import shared_dir
from framewright.sources import files
from framewright.sources.tables import Tables
from framewright.streaming.sinks import run_to_table, unique_name
from framewright.streaming.sources import file_stream


def _orders_csv(spark, sf_dir):
    """Orders written as CSV with a header; returns the folder and the written frame's schema."""
    out = shared_dir(spark, "orders-csv")
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                            "o_orderpriority")
    files.write(o, out, "csv", header=True)
    return out, o.schema


# Fixed value: microsecond text form of event times (the writer's default keeps milliseconds only).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _events_json(spark, sf_dir) -> str:
    out = shared_dir(spark, "events-json")
    ev = Tables(spark, sf_dir).events.select("event_id", "ts", "user_id", "event_type", "value")
    files.write(ev, out, "json", timestampNTZFormat=TS_FORMAT)
    return out


@register("csv_scan_inferred", covers=("S1", "S2"), oracle="""
SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total_price,
       CAST(max(o_custkey) AS INTEGER) AS max_cust
FROM orders GROUP BY o_orderpriority
""")
def csv_scan_inferred(spark, sf_dir):
    path, _ = _orders_csv(spark, sf_dir)
    df = files.read_csv(spark, os.path.join(path, "*.csv"))          # many part files as one table
    return df.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"),
                                             F.round(F.sum("o_totalprice"), 2).alias("total_price"),
                                             F.max("o_custkey").alias("max_cust"))


EVENTS_JSON_SCHEMA = StructType([
    StructField("event_id", LongType(), False, metadata={"source": "events"}),
    StructField("ts", TimestampNTZType(), True),
    StructField("user_id", LongType(), True),
    StructField("event_type", StringType(), True),
    StructField("value", DoubleType(), True),
])


@register("json_scan_declared", covers=("S4",), oracle="""
SELECT event_id, ts, user_id, event_type, value FROM events
""")
def json_scan_declared(spark, sf_dir):
    return files.read_json(spark, _events_json(spark, sf_dir), EVENTS_JSON_SCHEMA, timestampNTZFormat=TS_FORMAT)


@register("json_scan_inferred", covers=("S3",), oracle="""
SELECT event_type, count(*) AS n, max(user_id) AS max_user, max(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')) AS last_ts_text
FROM events GROUP BY event_type
""")
def json_scan_inferred(spark, sf_dir):
    df = files.read_json(spark, _events_json(spark, sf_dir))           # ts is inferred as text
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("user_id").alias("max_user"),
                                        F.max("ts").alias("last_ts_text"))


@register("stream_csv_count", covers=("S12", "R1"), oracle="""
SELECT o_orderstatus, count(*) AS count FROM orders GROUP BY o_orderstatus
""")
def stream_csv_count(spark, sf_dir):
    path, schema = _orders_csv(spark, sf_dir)   # declared schema: no pass over the files infers it
    stream = file_stream(spark, path, "csv", schema, glob="*.csv", header=True)
    return run_to_table(stream.groupBy("o_orderstatus").count(), "complete", unique_name("stream_csv_count"), spark)


@register("orc_scan_by_range", covers=("ORC scan",), oracle="""
SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS quantity, min(CAST(l_shipdate AS DATE)) AS first_date,
       max(CAST(l_shipdate AS DATE)) AS last_date
FROM lineitem WHERE CAST(l_shipdate AS DATE) >= DATE '1995-03-01' AND CAST(l_shipdate AS DATE) < DATE '1995-06-01'
GROUP BY l_returnflag
""")
def orc_scan_by_range(spark, sf_dir):
    """One quarter of lineitem from ORC files that hold ranges of the ship date: the filter skips the others."""
    out = shared_dir(spark, "lineitem-orc")
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("ship_date"),
                                               "l_returnflag", "l_quantity", "l_extendedprice")
    files.write_orc(li, out, sort_by=["ship_date", "l_orderkey", "l_linenumber"])
    df = files.read_orc(spark, out).where("ship_date >= DATE'1995-03-01' AND ship_date < DATE'1995-06-01'")
    return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"),
                                          F.min("ship_date").alias("first_date"), F.max("ship_date").alias("last_date"))


@register("orc_scan_by_partition", covers=("ORC scan",), oracle="""
SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'click' AND user_id IN (3, 5, 8, 13, 21)
""")
def orc_scan_by_partition(spark, sf_dir):
    """Clicks of some users from ORC files in folders by event type, with Bloom filters on the user."""
    out = shared_dir(spark, "events-orc")
    ev = Tables(spark, sf_dir).events.select("event_id", "user_id", "ts", "event_type", "value")
    files.write_orc(ev, out, sort_by=["ts", "event_id"], bloom=["user_id"], partition_by=["event_type"])
    df = files.read_orc(spark, out).where((F.col("event_type") == "click") & F.col("user_id").isin(3, 5, 8, 13, 21))
    return df.select("event_id", "user_id", "ts", "value")
