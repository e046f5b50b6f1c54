"""Joins on golden micro-tables, join properties, and a hot-key fixture."""

import pytest
from pyspark.sql import functions as F

from framewright.operators import joins


@pytest.fixture(scope="module")
def workshop(spark):
    """Repair jobs (each at one bench, with the tool codes it needs), benches and tools.  Bench 30 has
    no job, job 'dial' stands at a bench that does not exist, and one job lists a tool twice."""
    job = spark.createDataFrame(
        [("lens", 10, ["clamp", "loupe"]), ("gear", 10, ["file"]), ("case", 20, ["file", "file", "glue"]), ("dial", 40, [])],
        "job string, bench long, tools array<string>")
    bench = spark.createDataFrame([(10, "window", 4.5), (20, "door", 3.0), (30, "stairs", 2.25)],
                                  "bench_no long, place string, width double")
    tool = spark.createDataFrame([("clamp", 2), ("file", 7), ("glue", 1), ("saw", 5)], "code string, shelf int")
    return job, bench, tool


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_golden_rows(spark, workshop):
    job, bench, tool = workshop
    on = [("bench", "bench_no")]
    assert _rows(joins.join(job, bench, on).select("job", "place")) == [("case", "door"), ("gear", "window"), ("lens", "window")]
    assert _rows(joins.outer_join(job, bench, on, "full").select("job", "place")) == sorted(
        [("case", "door"), ("dial", None), ("gear", "window"), ("lens", "window"), (None, "stairs")], key=repr)
    assert joins.outer_join(job, bench, on, "left").count() == 4
    assert joins.outer_join(job, bench, on, "right").count() == 4
    assert _rows(joins.semi_join(bench, job, [("bench_no", "bench")]).select("place")) == [("door",), ("window",)]
    assert _rows(joins.anti_join(bench, job, [("bench_no", "bench")]).select("place")) == [("stairs",)]
    assert joins.cross_product(job, bench).count() == 12
    # A tool that a job lists twice does not double the pair; 'loupe' is not in the store.
    assert _rows(joins.array_member_join(job, "tools", tool, "code").select("job", "shelf")) == [
        ("case", 1), ("case", 7), ("gear", 7), ("lens", 2)]


def test_semi_keeps_duplicate_left_rows(spark, workshop):
    job, bench, _ = workshop
    twice = bench.unionByName(bench.where("place = 'door'"))
    assert _rows(joins.semi_join(twice, job, [("bench_no", "bench")]).select("bench_no")) == [(10,), (20,), (20,)]


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_skew_safe_outer_equals_spark_join(spark, how):
    # One key holds a third of the right side; null keys on both sides.
    left = spark.createDataFrame([(k, f"l{k}") for k in range(50)] + [(None, "lnull")], "lk long, lv string")
    right_rows = [(7, i) for i in range(100)] + [(k, k) for k in range(25, 225)] + [(None, -1)]
    right = spark.createDataFrame(right_rows, "rk long, rv long")
    safe = joins.outer_join(left, right, [("lk", "rk")], how, skew_safe=True)
    plain = joins.outer_join(left, right, [("lk", "rk")], how, skew_safe=False)
    assert _rows(safe) == _rows(plain)


def test_semi_anti_partition_left(spark):
    left = spark.range(0, 300).select((F.col("id") % 40).alias("k"), "id")
    right = spark.range(0, 100).select((F.col("id") % 17).alias("rk"))
    semi = joins.semi_join(left, right, [("k", "rk")])
    anti = joins.anti_join(left, right, [("k", "rk")])
    assert semi.count() + anti.count() == left.count()
    assert set(r.id for r in semi.collect()).isdisjoint(r.id for r in anti.collect())


def test_array_member_join_plans_equi_join(spark, workshop):
    job, _, tool = workshop
    plan = joins.array_member_join(job, "tools", tool, "code")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


def test_keep_both_keys_and_drop_and_rename(spark, workshop):
    job, bench, _ = workshop
    both = joins.join_keep_both_keys(job, bench, "bench", "bench_no")
    assert both.select("l.bench", "r.bench_no").count() == 3
    dropped = joins.join_drop_right_key(job, bench.withColumnRenamed("bench_no", "bench"), "bench")
    assert dropped.columns.count("bench") == 1
    renamed = joins.join_renamed(job, bench, "bench", "bench_no")
    assert "bench_no" not in renamed.columns and renamed.count() == 3


def test_cross_with_condition_is_inner(spark, workshop):
    job, bench, _ = workshop
    cond = job["bench"] == bench["bench_no"]
    assert _rows(job.join(bench, cond, "cross")) == _rows(job.join(bench, cond, "inner"))
