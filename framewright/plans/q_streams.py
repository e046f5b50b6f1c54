"""Structured Streaming queries over the events table.

Each builder runs a streaming query over the ``events`` table of the folder (a file or a folder of
part files, all of it in one parallel batch, so no row is late), drains it into its sink and returns
the result table as a batch frame.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from framewright.plans.catalog import register
from framewright.session import drop_dir, shared_dir
from framewright.sources.tables import Tables
from framewright.streaming import operators as so
from framewright.streaming.sinks import committed_batches, read_result, run_to_table, start, unique_name
from framewright.streaming.sources import file_stream, table_stream
from framewright.streaming.stateful import keyed_visits, route_late


def _events(spark, sf_dir):
    return table_stream(spark, sf_dir, "events")


def _drain(df, mode, name, spark, sf_dir):
    return run_to_table(df, mode, unique_name(name), spark, source=Tables(spark, sf_dir).events)


@register("stream_count", covers=("R1", "R12", "R14", "R15", "R16", "R17", "S13", "S19", "S20", "P15"), oracle="""
SELECT event_type, count(*) AS count FROM events GROUP BY event_type
""")
def stream_count(spark, sf_dir):
    counts = so.count_by(_events(spark, sf_dir), "event_type")
    return _drain(counts, "complete", "stream_count", spark, sf_dir)


@register("stream_fixed_interval", covers=("R11", "R1", "R16"), oracle="""
SELECT event_type, count(*) AS count FROM events GROUP BY event_type
""")
def stream_fixed_interval(spark, sf_dir):
    """A fixed-interval trigger: batches are tried every second; all that is there is waited for and
    the query is stopped."""
    counts = so.count_by(_events(spark, sf_dir), "event_type")
    q, data = start(counts, "complete", unique_name("stream_fixed_interval"), spark, processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return read_result(counts, "complete", data, spark, any_batch=True)


@register("stream_filter", covers=("R2", "F12", "F13"), oracle="""
SELECT event_id, user_id, event_type FROM events
WHERE event_type LIKE '%i%' AND props IS NOT NULL
""")
def stream_filter(spark, sf_dir):
    ev = _events(spark, sf_dir)
    out = (ev.withColumn("has_i", F.expr("event_type LIKE '%i%'")).where("has_i")
           .where("props IS NOT NULL").select("event_id", "user_id", "event_type"))
    return _drain(out, "append", "stream_filter", spark, sf_dir)


@register("stream_cube", covers=("R3", "A20", "A22"), oracle="""
SELECT event_type, user_id, round(sum(value), 2) / count(value) AS avg_value,
       grouping(event_type, user_id) AS grouping_id
FROM events GROUP BY CUBE (event_type, user_id)
""")
def stream_cube(spark, sf_dir):
    ev = _events(spark, sf_dir).drop("props", "ts")
    # The stream keeps sums and counts by the full key; the cube's levels are made from those groups,
    # so no event is expanded.  Averages as (sum rounded to the data's 2 decimals) / count: the same
    # double in any engine and any summation order, so results compare exactly.
    groups = ev.groupBy("event_type", "user_id").agg(F.sum("value").alias("s"), F.count("value").alias("n"))
    res = _drain(groups, "complete", "stream_cube", spark, sf_dir)
    return res.cube("event_type", "user_id").agg((F.round(F.sum("s"), 2) / F.sum("n")).alias("avg_value"),
                                                 F.grouping_id().alias("grouping_id"))


@register("stream_static_join", covers=("R4", "J15"), oracle="""
SELECT s.event_type, s.user_id, s.stream_avg, h.static_max
FROM (SELECT event_type, user_id, round(sum(value), 2) / count(value) AS stream_avg
      FROM events GROUP BY CUBE (event_type, user_id)) s
JOIN (SELECT event_type, user_id, max(value) AS static_max FROM events GROUP BY event_type, user_id) h
  USING (event_type, user_id)
""")
def stream_static_join(spark, sf_dir):
    static = Tables(spark, sf_dir).events.groupBy("event_type", "user_id").agg(F.max("value").alias("static_max"))
    # A cube's subtotal rows carry null keys and find no partner in an inner join on both keys, so the
    # full key's groups are all that the join needs of it.
    groups = (_events(spark, sf_dir).select("event_type", "user_id", "value")
              .groupBy("event_type", "user_id").agg((F.round(F.sum("value"), 2) / F.count("value")).alias("stream_avg")))
    joined = groups.join(static, ["event_type", "user_id"])
    res = _drain(joined, "complete", "stream_static_join", spark, sf_dir)
    return res.select("event_type", "user_id", "stream_avg", "static_max")


@register("stream_tumbling", covers=("R5", "D12", "A26"), oracle="""
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       user_id, round(sum(value), 2) AS total_value
FROM events GROUP BY 1, 2, user_id
""")
def stream_tumbling(spark, sf_dir):
    out = so.windowed(_events(spark, sf_dir), "ts", "1 day", None, ["user_id"],
                      F.sum("value").alias("total_value"))
    res = _drain(out, "complete", "stream_tumbling", spark, sf_dir)
    return res.select("window_start", "window_end", "user_id", F.round("total_value", 2).alias("total_value"))


@register("stream_tumbling_count", covers=("R6",), oracle="""
SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS window_start,
       time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE AS window_end, count(*) AS count
FROM events GROUP BY 1, 2
""")
def stream_tumbling_count(spark, sf_dir):
    out = so.windowed(_events(spark, sf_dir), "ts", "10 minutes", None, [], F.count(F.lit(1)).alias("count"))
    return _drain(out, "complete", "stream_tumbling_count", spark, sf_dir)


_SLIDING_SQL = """
SELECT ws AS window_start, ws + INTERVAL 10 MINUTE AS window_end, count(*) AS count
FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS ws FROM events
      UNION ALL
      SELECT time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE FROM events)
GROUP BY ws
"""


@register("stream_sliding", covers=("R7",), oracle=_SLIDING_SQL)
def stream_sliding(spark, sf_dir):
    out = so.windowed(_events(spark, sf_dir), "ts", "10 minutes", "5 minutes", [], F.count(F.lit(1)).alias("count"))
    return _drain(out, "complete", "stream_sliding", spark, sf_dir)


@register("stream_watermark", covers=("R8",), oracle=f"""
SELECT * FROM ({_SLIDING_SQL})
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 30 MINUTE
""")
def stream_watermark(spark, sf_dir):
    """Append mode: a window is emitted once the watermark (max event time - 30 minutes)
    passes its end; windows still open at the end of the input are not emitted."""
    out = so.windowed(_events(spark, sf_dir), "ts", "10 minutes", "5 minutes", [], F.count(F.lit(1)).alias("count"),
                      watermark="30 minutes")
    return _drain(out, "append", "stream_watermark", spark, sf_dir)


@register("stream_dedup", covers=("R9",), oracle="""
SELECT user_id, count(*) AS count FROM (SELECT DISTINCT user_id, ts FROM events) GROUP BY user_id
""")
def stream_dedup(spark, sf_dir):
    ev, again = (_events(spark, sf_dir).select("user_id", "ts") for _ in range(2))      # every event twice
    deduped = so.deduplicated(ev.unionByName(again), ["user_id"], "ts", "5 seconds")
    counts = deduped.groupBy("user_id").count()
    return _drain(counts, "complete", "stream_dedup", spark, sf_dir)


@register("stream_chained_windows", covers=("Q17", "R8"), oracle="""
WITH ten AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS w, user_id, count(*) AS c FROM events GROUP BY 1, 2)
SELECT * FROM (
  SELECT time_bucket(INTERVAL 1 HOUR, w) AS window_start, time_bucket(INTERVAL 1 HOUR, w) + INTERVAL 1 HOUR AS window_end,
         CAST(sum(c) AS BIGINT) AS n, max(c) AS peak
  FROM ten GROUP BY 1, 2)
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 30 MINUTE
""")
def stream_chained_windows(spark, sf_dir):
    """Two levels of windowed aggregation in append mode (events per user and 10 minutes, then per
    hour the total and the busiest user-window); hours still open at the end are not emitted."""
    ev = so.event_time(_events(spark, sf_dir), "ts").withWatermark("event_time", "30 minutes")
    first = ev.groupBy(F.window("event_time", "10 minutes").alias("w"), "user_id").count()
    second = so.coarser_windows(first, "w", "1 hour", F.sum("count").alias("n"), F.max("count").alias("peak"))
    return _drain(so.flat_window(second, "window", to_ntz=True), "append", "stream_chained_windows", spark, sf_dir)


@register("stream_stream_join", covers=("Q17", "J1"), oracle="""
SELECT c.event_id AS click_id, p.event_id AS purchase_id
FROM events c JOIN events p
  ON c.user_id = p.user_id AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 1 HOUR
WHERE c.event_type = 'click' AND p.event_type = 'purchase'
""")
def stream_stream_join(spark, sf_dir):
    """Inner join of two streams: purchases within an hour after a click by the same user; the
    join state is salted four ways so a hot user does not sit in one state partition."""
    def side(kind, prefix):
        ev = so.event_time(_events(spark, sf_dir), "ts").where(F.col("event_type") == kind)
        return ev.withWatermark("event_time", "30 minutes").select(
            F.col("event_id").alias(f"{prefix}_id"), F.col("user_id").alias(f"{prefix}_user"),
            F.col("event_time").alias(f"{prefix}_time"))
    j = so.time_bounded_join(side("click", "click"), side("purchase", "purchase"),
                             [("click_user", "purchase_user")], "click_time", "purchase_time", "1 hour",
                             salt=4, left_id="click_id")
    return _drain(j.select("click_id", "purchase_id"), "append", "stream_stream_join", spark, sf_dir)


@register("stream_cube_inside", covers=("R3", "A20", "A22"), oracle="""
SELECT event_type, user_id, round(sum(value), 2) / count(value) AS avg_value,
       grouping(event_type, user_id) AS grouping_id
FROM events GROUP BY CUBE (event_type, user_id)
""")
def stream_cube_inside(spark, sf_dir):
    """The cube on the stream itself: its state holds every level (``stream_cube`` keeps the full key only)."""
    ev = _events(spark, sf_dir).select("event_type", "user_id", "value")
    cube = ev.cube("event_type", "user_id").agg((F.round(F.sum("value"), 2) / F.count("value")).alias("avg_value"),
                                                F.grouping_id().alias("grouping_id"))
    return _drain(cube, "complete", "stream_cube_inside", spark, sf_dir)


def _in_parts(spark, sf_dir, part, parts, files):
    """Events written part by part, each as a few files, so that a stream reads the parts in order."""
    folder = shared_dir(spark, "event-files")
    ev = Tables(spark, sf_dir).events
    for k in range(parts):
        ev.where(part == k).repartition(files).write.mode("append").parquet(folder)
    return folder, ev


@register("stream_limited_files", covers=("R13", "R1", "R17"), oracle="""
SELECT event_type, count(*) AS count, round(sum(value), 2) AS total, true AS several_batches FROM events GROUP BY event_type
""")
def stream_limited_files(spark, sf_dir):
    """At most two of eight files a batch: counts and sums are carried from batch to batch in the state; the
    checkpoint says that there were three batches or more."""
    folder, ev = _in_parts(spark, sf_dir, F.lit(0), 1, 8)
    stream = file_stream(spark, folder, "parquet", ev.schema, max_files_per_trigger=2)
    counts = stream.groupBy("event_type").agg(F.count(F.lit(1)).alias("count"), F.sum("value").alias("total"))
    base = shared_dir(spark, "stream_limited_files")
    res = run_to_table(counts, "complete", unique_name("stream_limited_files"), spark, out_dir=base, source=ev)
    batches = committed_batches(spark, base)
    drop_dir(spark, folder)
    return res.select("event_type", "count", F.round("total", 2).alias("total"), F.lit(batches >= 3).alias("several_batches"))


@register("stream_sessions", covers=("session windows", "R8"), oracle="""
WITH flagged AS (
  SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 3 HOUR THEN 0 ELSE 1 END AS new FROM events),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS nth FROM flagged)
SELECT min(ts) AS window_start, max(ts) + INTERVAL 3 HOUR AS window_end, user_id, count(*) AS n_events, max(value) AS largest
FROM numbered GROUP BY user_id, nth HAVING max(ts) + INTERVAL 3 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 30 MINUTE
""")
def stream_sessions(spark, sf_dir):
    """Session windows of three hours per user in append mode; sessions still open at the end are not emitted."""
    out = so.session_windows(_events(spark, sf_dir), "ts", "3 hours", ["user_id"], F.count(F.lit(1)).alias("n_events"),
                             F.max("value").alias("largest"), watermark="30 minutes")
    return _drain(out, "append", "stream_sessions", spark, sf_dir)


@register("stream_keyed_visits", covers=("keyed state functions",), oracle="""
WITH flagged AS (
  SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 2 HOUR THEN 0 ELSE 1 END AS new FROM events),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS nth FROM flagged)
SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n_rows
FROM numbered GROUP BY user_id, nth HAVING max(ts) + INTERVAL 2 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
""")
def stream_keyed_visits(spark, sf_dir):
    """Visits by a state function with event-time timeouts, one state per user."""
    return _drain(keyed_visits(_events(spark, sf_dir), "user_id", "ts", 2 * 3600, "10 minutes"), "append", "stream_keyed_visits", spark, sf_dir)


@register("stream_late_rows", covers=("late-data side output",), oracle="""
WITH part AS (SELECT event_id, event_type, ts, event_id % 3 AS part FROM events),
judged AS (
  SELECT event_id, event_type, ts < (SELECT max(b.ts) FROM part b WHERE b.part < a.part) - INTERVAL 20 DAY AS late FROM part a)
SELECT event_type, coalesce(late, false) AS late, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM judged GROUP BY 1, 2
""")
def stream_late_rows(spark, sf_dir):
    """Events in three batches that each span the whole time: rows over twenty days behind the greatest time of
    the batches before go to the side output; both outputs together are the input."""
    folder, ev = _in_parts(spark, sf_dir, F.col("event_id") % 3, 3, 4)
    stream = file_stream(spark, folder, "parquet", ev.schema, max_files_per_trigger=4)
    on_time, late = route_late(stream, "ts", 20 * 86_400, unique_name("stream_late_rows"))
    drop_dir(spark, folder)
    both = on_time.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))
    return both.groupBy("event_type", "late").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))
