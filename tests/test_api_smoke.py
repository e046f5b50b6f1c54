"""Every public helper runs and returns what its docstring says on a small input."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from framewright.functions import dates, strings
from framewright.operators import aggregate as agg
from framewright.operators import filters, nested, nulls, project
from framewright.sources import files
from framewright.streaming import operators as so
from framewright.streaming.sinks import run_to_table, unique_name
from framewright.streaming.sources import file_stream
from tests.conftest import SF001


def test_projection_and_filter_helpers(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (2, "b", None)], "id long, s string, x double")
    assert project.select_names(df, "*").columns == df.columns
    assert project.select_expressions(df, "id + 1 AS nid", "id = 1 AS first").columns == ["nid", "first"]
    assert project.with_columns(df, {"y": F.col("id") * 2}).first().y == 2
    assert project.drop_columns(df, "s", "nope").columns == ["id", "x"]
    assert filters.where(df, "id > 0", F.col("s") == "b").count() == 1
    assert df.where(filters.all_of(F.col("id") > 0, F.col("x").isNull())).count() == 1
    early, late = filters.time_split(
        spark.createDataFrame([(dt.date(2020, 1, 1),), (dt.date(2021, 1, 1),)], "d date"), "d", "2020-06-01")
    assert (early.count(), late.count()) == (1, 1)


def test_aggregate_helpers(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), ("a", 3.0, "y"), ("b", 5.0, "x")], "k string, v double, o string")
    assert agg.row_count(df).first().n == 3
    g = agg.group_agg(df, ["k"], agg.conditional_sum("v", F.col("o") == "x", F.col("v") > 2, name="t"))
    assert {r.k: r.t for r in g.collect()} == {"a": 1.0 + 3.0, "b": 5.0 + 5.0}
    assert agg.numeric_columns(df) == ["v"]
    assert agg.distinct_rows(df, "k").count() == 2
    assert agg.averages_of_numeric(df, ["k"]).columns == ["k", "avg_v"]
    tb = agg.time_bucket(spark.createDataFrame([("u", dt.datetime(2024, 1, 1, 10))], "u string, ts timestamp_ntz"),
                         ["u"], "ts", "1 hour", F.count(F.lit(1)).alias("n"), slide="30 minutes")
    assert tb.count() == 2 and tb.columns == ["u", "window_start", "window_end", "n"]


def test_nested_and_null_helpers(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x"}', ["p", "q"])], "j string, arr array<string>")
    r = df.select(nested.parse_json("j", "a INT, b STRING").alias("s"), nested.has_element("arr", "q").alias("h"),
                  nested.array_size("arr").alias("n"), nested.make_struct("j").alias("m")).first()
    assert r.s.a == 1 and r.h is True and r.n == 2
    assert nested.json_fields(df, "j", ["a", "b"]).first().asDict() == {"a": "1", "b": "x"}
    assert df.select(nested.field(nested.make_struct("j"), "j").alias("f")).first().f == df.first().j
    m = nested.map_from_columns(spark.createDataFrame([("k", 1)], "k string, v int"), "k", "v")
    assert nested.explode_map(m.select("m"), "m").first().asDict() == {"key": "k", "value": 1}
    filled = nulls.fill_nulls_by_column(spark.createDataFrame([(None, None)], "a int, b string"), {"a": 7, "b": "z"})
    assert tuple(filled.first()) == (7, "z")


def test_scalar_helpers(spark):
    r = spark.range(1).select(
        strings.lower(F.lit("AbC")).alias("lo"), dates.add_days(F.to_date(F.lit("2024-02-28")), 2).alias("d"),
        dates.from_epoch_nanos_double(F.lit(1_000_000_000_000_000_000)).cast("timestamp_ntz").alias("t"),
        dates.window_bucket(F.lit("2024-01-01 10:07:00").cast("timestamp_ntz"), "10 minutes").alias("w"),
        *[c.alias(f"now{i}") for i, c in enumerate(dates.today_and_now())]).first()
    assert r.lo == "abc" and r.d == dt.date(2024, 3, 1) and r.t == dt.datetime(2001, 9, 9, 1, 46, 40)
    assert r.w.start == dt.datetime(2024, 1, 1, 10, 0) and isinstance(r.now0, dt.date)


def test_partitioned_write_and_declared_parquet_read(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="fw-w-"), "nation")
    files.write(files.read_parquet(spark, f"{SF001}/nation.parquet"), d, partition_by=["n_regionkey"])
    back = files.read_parquet(spark, d)
    assert back.count() == 25 and "n_regionkey=2" in os.listdir(d)
    assert back.where("n_regionkey = 2").count() == 5


def test_dedup_within_watermark_form(spark):
    d = tempfile.mkdtemp(prefix="fw-dw-")
    with open(os.path.join(d, "a.json"), "w") as fh:
        for ts in ("10:00:00", "10:00:01", "10:00:00"):
            fh.write('{"u": "x", "ts": "2024-01-01 %s"}\n' % ts)
    stream = file_stream(spark, d, "json", "u string, ts timestamp")
    out = run_to_table(so.deduplicated(stream, ["u"], "ts", "1 minute", within_watermark=True), "append",
                       unique_name("dw"), spark)
    assert out.count() == 1
