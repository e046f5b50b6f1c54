"""Session windows, keyed state and late rows over several batches, restarts and odd rows."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from framewright.streaming import operators as so
from framewright.streaming.sinks import committed_batches, run_to_table, unique_name
from framewright.streaming.sources import file_stream
from framewright.streaming.stateful import keyed_visits, route_late

DAY = dt.datetime(2024, 1, 1)
SCHEMA = "k string, t timestamp_ntz, v int"


def at(minutes):
    return None if minutes is None else DAY + dt.timedelta(minutes=minutes)


def write(spark, folder, *parts):
    for rows in parts:
        spark.createDataFrame([(k, at(m), v) for k, m, v in rows], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def visits(rows, gap, upto):
    out = []
    for k in {r[0] for r in rows}:
        run = []
        for m in [*sorted(m for x, m, _ in rows if x == k and m is not None), 10 ** 9]:
            if run and m - run[-1] > gap:
                if run[-1] + gap <= upto:
                    out.append((k, at(run[0]), at(run[-1]), len(run)))
                run = []
            run.append(m)
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def parts():
    """Three batches in order of time with some disorder inside; one visit reaches over all of them."""
    dice = random.Random(2)
    out = [[(dice.choice(["hot", "hot", "a", "b", None]), 200 * b + dice.randint(0, 200), dice.randint(1, 9)) for _ in range(80)] for b in range(3)]
    for b, rows in enumerate(out):
        rows += [("long", m, 1) for m in range(200 * b, 200 * b + 200, 9)] + rows[:5] + [("a", None, 1)]
    out.append([("end", 5000, 1)])
    return out


def test_session_windows_join_over_batches(spark, parts):
    src = tempfile.mkdtemp(prefix="fw-sess-")
    write(spark, src, *parts)
    stream = file_stream(spark, src, "parquet", SCHEMA, max_files_per_trigger=1)
    out = so.session_windows(stream.where("t IS NOT NULL"), "t", "10 minutes", ["k"], F.count(F.lit(1)).alias("n"), watermark="250 minutes")
    base = tempfile.mkdtemp(prefix="fw-sess-out-")
    res = run_to_table(out, "append", unique_name("sess"), spark, out_dir=base)
    assert committed_batches(spark, base) >= 4
    got = found(res.select("k", "window_start", F.expr("window_end - INTERVAL 10 MINUTE"), "n"))
    assert got == visits([r for p in parts for r in p], 10, 4750)
    assert max(n for *_, n in got if n) >= 67           # the long one is one session


def test_keyed_visits_are_carried_over_batches_and_restarts(spark, parts):
    """The same checkpoint, started again for each file: state and results go on where they were."""
    src, base = tempfile.mkdtemp(prefix="fw-kv-"), tempfile.mkdtemp(prefix="fw-kv-out-")
    for n, rows in enumerate(parts):
        write(spark, src, rows)
        stream = file_stream(spark, src, "parquet", SCHEMA)
        res = run_to_table(keyed_visits(stream, "k", "t", 600, "250 minutes"), "append", unique_name("kv"), spark, out_dir=base)
        if n == 1:
            assert not [r for r in found(res) if r[0] == "long"]     # still open
    assert found(res) == visits([r for p in parts for r in p], 10, 4750)


def test_keyed_visits_of_an_empty_stream(spark):
    src = tempfile.mkdtemp(prefix="fw-kv-none-")
    res = run_to_table(keyed_visits(file_stream(spark, src, "parquet", SCHEMA), "k", "t", 60, "1 minute"), "append", unique_name("kvn"), spark)
    assert res.count() == 0 and res.columns == ["k", "first_ts", "last_ts", "n_rows"]


def test_late_rows_go_to_the_side_output(spark):
    batches = [[("a", 100, 1), ("b", 50, 2), ("c", None, 3)], [("a", 89, 4), ("b", 90, 5), ("c", 130, 6), ("c", None, 7)],
               [("a", 119, 8), ("a", 120, 9), ("a", 119, 8)], [("a", 125, 10)]]
    src = tempfile.mkdtemp(prefix="fw-late-")
    write(spark, src, *batches)
    on_time, late = route_late(file_stream(spark, src, "parquet", SCHEMA, max_files_per_trigger=1), "t", 600, unique_name("late"))
    assert on_time.columns == late.columns == ["k", "t", "v", "batch"]
    assert sorted((r.v, r.batch) for r in late.collect()) == [(4, 1), (8, 2), (8, 2)]
    assert sorted(r.v for r in on_time.collect()) == [1, 2, 3, 5, 6, 7, 9, 10]


def test_late_rows_after_a_restart_and_on_nothing(spark):
    src, base = tempfile.mkdtemp(prefix="fw-late-"), tempfile.mkdtemp(prefix="fw-late-out-")
    stream = lambda: file_stream(spark, src, "parquet", SCHEMA)
    on_time, late = route_late(stream(), "t", 60, unique_name("late"), out_dir=base)
    assert on_time.count() == late.count() == 0 and late.columns == ["k", "t", "v", "batch"]
    write(spark, src, [("a", 100, 1)])
    route_late(stream(), "t", 60, unique_name("late"), out_dir=base)
    write(spark, src, [("a", 98, 2), ("a", 99, 3)])
    on_time, late = route_late(stream(), "t", 60, unique_name("late"), out_dir=base)
    assert [r.v for r in late.collect()] == [2] and sorted(r.v for r in on_time.collect()) == [1, 3]


def test_a_stream_that_misses_its_input_raises(spark):
    """An empty folder as the stream, but a table with rows as its source."""
    src = tempfile.mkdtemp(prefix="fw-miss-")
    stream = file_stream(spark, src, "json", "k string")
    for mode, df in (("complete", stream.groupBy("k").count()), ("append", stream)):
        with pytest.raises(RuntimeError, match="read nothing"):
            run_to_table(df, mode, unique_name("miss"), spark, source=spark.range(3))
        assert run_to_table(df, mode, unique_name("none"), spark, source=spark.range(0)).count() == 0
