"""Streaming = batch over several micro-batches; late rows against a watermark; dedup; sinks."""

import json
import os
import random
import tempfile
import time

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from framewright.plans.catalog import load_all
from framewright.sources import kafka
from framewright.sources.tables import TABLES
from framewright.streaming import operators as so
from framewright.streaming.sinks import run_to_table, start, unique_name
from framewright.streaming.sources import file_stream, schema_of, table_stream
from tests.conftest import SF001
from tests.oracle import compare


def _split_events(n_files=5):
    """Test fixture: the small events table split by event time into files with increasing mtimes."""
    d = tempfile.mkdtemp(prefix="fw-stream-")
    t = pq.read_table(f"{SF001}/events.parquet").sort_by("ts")
    step = (t.num_rows + n_files - 1) // n_files
    now = time.time() - 100
    for i in range(n_files):
        p = os.path.join(d, f"part-{i}.parquet")
        pq.write_table(t.slice(i * step, step), p)
        os.utime(p, (now + i, now + i))
    return d


def test_stream_equals_batch_over_several_batches(spark):
    d = _split_events()
    schema = schema_of(spark, f"{SF001}/events.parquet")
    stream = file_stream(spark, d, "parquet", schema, max_files_per_trigger=1)
    name = unique_name("t_count")
    q, _ = start(so.count_by(stream, "event_type"), "complete", name, spark)
    q.awaitTermination(120)
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 5
    out = run_to_table(so.count_by(file_stream(spark, d, "parquet", schema, max_files_per_trigger=1), "event_type"),
                       "complete", unique_name("t_count2"), spark)
    batch = spark.read.parquet(d).groupBy("event_type").count()
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, batch.collect()))


def test_late_rows_dropped_after_watermark(spark):
    d = tempfile.mkdtemp(prefix="fw-late-")
    files = [["12:00", "12:01"], ["12:20"], ["13:00"], ["12:05"], ["13:45", "11:00"]]
    now = time.time() - 100
    for i, stamps in enumerate(files):
        p = os.path.join(d, f"f{i}.json")
        with open(p, "w") as fh:
            for s in stamps:
                fh.write(json.dumps({"user": "u", "ts": f"2024-01-01 {s}:00"}) + "\n")
        os.utime(p, (now + i, now + i))
    stream = file_stream(spark, d, "json", "user string, ts timestamp", max_files_per_trigger=1)
    agg = so.windowed(stream, "ts", "10 minutes", None, [], F.count(F.lit(1)).alias("n"), watermark="30 minutes")
    out = run_to_table(agg, "append", unique_name("late"), spark)
    res = {r.hm: r.n for r in out.select(F.date_format("window_start", "HH:mm").alias("hm"), "n").collect()}
    assert "11:00" not in res                 # far behind the watermark: dropped
    assert res["12:00"] == 3                  # 13:00 moved the watermark to 12:30 only after the 12:05 batch was planned
    assert res["12:20"] == 1 and res["13:00"] == 1
    assert "13:40" not in res                 # still open when the input ends


def test_dedup_within_watermark(spark):
    d = _split_events(2)
    schema = schema_of(spark, f"{SF001}/events.parquet")
    a = file_stream(spark, d, "parquet", schema, max_files_per_trigger=1).select("user_id", "ts")
    b = file_stream(spark, d, "parquet", schema, max_files_per_trigger=1).select("user_id", "ts")
    counts = so.deduplicated(a.unionByName(b), ["user_id"], "ts", "5 seconds").groupBy("user_id").count()
    out = run_to_table(counts, "complete", unique_name("dedup"), spark)
    exp = spark.read.parquet(d).select("user_id", "ts").distinct().groupBy("user_id").count()
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, exp.collect()))


def test_memory_sink_and_interval_trigger(spark):
    d = _split_events(2)
    schema = schema_of(spark, f"{SF001}/events.parquet")
    name = unique_name("mem")
    q, _ = start(so.count_by(file_stream(spark, d, "parquet", schema), "event_type"), "complete", name, spark,
                 sink="memory", processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.table(name).count() == 5


def test_kafka_builders_without_broker(spark):
    with pytest.raises(ValueError):
        kafka.kafka_reader(spark, "host:9092")
    reader = kafka.kafka_reader(spark, "host:9092", subscribe=["a", "b"])
    assert reader is not None
    df = spark.createDataFrame([("t1", 1, "v")], "topic string, k int, v string")
    recs = kafka.kafka_records(df, "v", key="k", topic="topic")
    assert recs.columns == ["topic", "key", "value"] and recs.first().key == "1"


def test_salted_stream_join_equals_unsalted(spark):
    d = _split_events(3)
    schema = schema_of(spark, f"{SF001}/events.parquet")

    def side(kind, prefix):
        ev = so.event_time(file_stream(spark, d, "parquet", schema, max_files_per_trigger=1), "ts")
        ev = ev.where(F.col("event_type") == kind).withWatermark("event_time", "30 minutes")
        return ev.select(F.col("event_id").alias(f"{prefix}_id"), F.col("user_id").alias(f"{prefix}_user"),
                         F.col("event_time").alias(f"{prefix}_time"))

    def run(salt):
        j = so.time_bounded_join(side("view", "a"), side("click", "b"), [("a_user", "b_user")], "a_time", "b_time",
                                 "2 hours", salt=salt, left_id="a_id")
        return sorted(map(tuple, run_to_table(j.select("a_id", "b_id"), "append", unique_name("sj"), spark).collect()))

    plain, salted = run(1), run(5)
    assert plain == salted and len(plain) > 0


@pytest.fixture(scope="module")
def many_files(spark):
    """Every test table as a folder of seven part files, rows in shuffled order."""
    d = tempfile.mkdtemp(prefix="fw-folders-")
    for name in sorted(os.listdir(SF001)):
        t = pq.read_table(os.path.join(SF001, name))
        rows = list(range(t.num_rows))
        random.Random(name).shuffle(rows)
        os.mkdir(os.path.join(d, name))
        for k in range(7):
            pq.write_table(t.take(pa.array(rows[k::7], pa.int64())), os.path.join(d, name, f"part-{k}.parquet"))
    return d


ORACLES = sorted(n for n, q in load_all().items() if q.oracle)


@pytest.mark.parametrize("name", ORACLES)
def test_queries_on_folders_of_shuffled_files(spark, many_files, name):
    q = load_all()[name]
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{many_files}/{t}.parquet/*.parquet')")
    compare(q.build(spark, many_files), con, q.oracle)


def test_files_per_trigger_limit_is_the_callers(spark, many_files):
    stream = table_stream(spark, many_files, "events", max_files_per_trigger=2)
    q, _ = start(so.count_by(stream, "event_type"), "complete", unique_name("limited"), spark)
    q.awaitTermination(300)
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 4


def test_input_that_reads_as_nothing_raises(spark, tmp_path):
    (tmp_path / "none").mkdir()
    stream = file_stream(spark, str(tmp_path / "none"), "parquet", schema_of(spark, f"{SF001}/events.parquet"))
    with pytest.raises(RuntimeError):
        run_to_table(so.count_by(stream, "event_type"), "complete", unique_name("nothing"), spark,
                     source=spark.read.parquet(f"{SF001}/events.parquet"))
