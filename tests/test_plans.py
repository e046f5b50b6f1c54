"""Plan checks: native queries stay in the JVM, filters and projections reach the scan,
top-k is planned as such, the array-membership join has no nested loop."""

import pytest
from pyspark.sql import functions as F

from framewright.plans.catalog import load_all
from tests.conftest import SF01

QUERIES = load_all()
PYTHON_ALLOWED = {"udf_cube", "udf_cube_sql", "kmeans_cost", "udaf_supplier_prices", "udaf_total_prices", "udtf_event_runs",
                  "udtf_event_runs_sql"}
BATCH = sorted(n for n in QUERIES if not n.startswith("stream_") and n not in PYTHON_ALLOWED)


def plan(spark, name):
    return QUERIES[name].build(spark, SF01)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_stage(spark, name):
    p = plan(spark, name)
    assert "EvalPython" not in p and "PythonUDF" not in p


def test_filters_and_columns_reach_scan(spark):
    p = plan(spark, "like_not_null")
    pushed = p.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    assert {"IsNotNull(event_type)", "IsNotNull(props)", "StringContains(event_type,i)"} <= set(pushed.split(", "))
    p = plan(spark, "top5_suppliers_by_quantity")
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in p


def test_top_k_and_equi_join(spark):
    assert "TakeOrderedAndProject" in plan(spark, "sorted_limits")
    assert "NestedLoop" not in plan(spark, "join_array_member")


def _final_plan(df):
    df.collect()                     # runs the frame's own adaptive plan to its final form
    return df._jdf.queryExecution().executedPlan().toString()


def test_outer_join_reuses_inner_join_shuffles(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # as at scale: no side is small
    try:
        p = _final_plan(QUERIES["join_full"].build(spark, SF01))
        assert p.count("ReusedExchange") >= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_ranked_report_window_reads_counts_not_rows(spark):
    from framewright.operators import windows
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    for method in ("slices", "counts"):
        df = windows.ranked_report(li, ["l_suppkey"], "l_quantity", method=method)
        optimized = df._jdf.queryExecution().optimizedPlan().toString()
        assert "count(1)" in optimized[optimized.index("Window ["):]
        assert dict(df.dtypes)["rank"] == dict(df.dtypes)["dense_rank"] == "bigint"


def test_levels_are_made_from_groups(spark):
    for name in ("agg_rollup", "agg_cube", "agg_grouping_sets"):
        p = plan(spark, name)
        assert "HashAggregate" in p.split("Expand", 1)[1]            # an aggregate below the expansion
    assert "Expand" not in plan(spark, "agg_counts")


def test_broadcast_within_a_size(spark):
    from framewright.plans.broadcast import broadcast_within, estimated_bytes
    small = spark.range(10)
    assert estimated_bytes(small) == 80
    joined = spark.range(100).join(broadcast_within(small), "id")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert broadcast_within(small, 79) is small


@pytest.fixture
def lowered_skew(spark):
    """No broadcasts, and skew thresholds at the size of the test's data."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("hot_side", ["left", "right"])
@pytest.mark.parametrize("kind", ["semi", "anti", "left", "right", "full"])
def test_hot_keys_are_split(spark, lowered_skew, kind, hot_side):
    from framewright.operators import joins
    n, m = (300_000, 4_000) if hot_side == "left" else (4_000, 300_000)
    key = lambda x, hot: F.when((F.col("id") % 10 < 6) & F.lit(hot), 7).otherwise(F.col("id") % 5000).alias(x)
    left = spark.range(n).select(key("k", hot_side == "left"), F.col("id").alias("a"))
    right = spark.range(m).select(key("j", hot_side == "right"), F.col("id").alias("b"))
    left = left.where((F.col("k") != 7) | (F.col("a") < 180_000)).repartition(4)
    right = right.where((F.col("j") != 7) | (F.col("b") % 50 == 0) if hot_side == "left" else F.lit(True)).repartition(4)
    on = [("k", "j")]
    df = {"semi": lambda: joins.semi_join(left, right, on), "anti": lambda: joins.anti_join(left, right, on)}.get(
        kind, lambda: joins.outer_join(left, right, on, kind))()
    df.write.format("noop").mode("overwrite").save()
    p = _final_plan(df)
    if hot_side == "left" or kind not in ("semi", "anti"):
        assert "SortMergeJoin(skew=true)" in p
    else:                                               # a hot lookup key has a bounded number of rows left
        assert "__bucket" in p
