"""The skew-safe ranked report equals the direct window form."""

from pyspark.sql import functions as F

from framewright.operators import windows
from tests.conftest import SF01


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_ranked_report_ties_nulls_and_hot_group(spark):
    rows = []
    # Hot group ("hot", 1) holds a third of the rows, with many ties.
    for i in range(300):
        rows.append(("hot", 1, float(i % 7) if i % 11 else None, i))
    for i in range(600):
        rows.append((f"g{i % 40}", i % 3, float(i % 5), i + 1000))
    rows.append((None, None, 3.0, 5000))
    rows.append((None, None, None, 5001))
    df = spark.createDataFrame(rows, "a string, b int, v double, id long")
    names = ("mx", "dr", "rk")
    fast = windows.ranked_report(df, ["a", "b"], "v", names)
    direct = windows.ranked_report_window(df, ["a", "b"], "v", names)
    assert fast.columns == direct.columns
    assert _rows(fast) == _rows(direct)
    for method in ("counts", "range"):
        assert _rows(windows.ranked_report(df, ["a", "b"], "v", names, method=method)) == _rows(direct)


def test_ranked_report_orders_per_customer(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet").select(
        "o_custkey", "o_orderkey", F.round("o_totalprice", -4).alias("price_band"))
    fast = windows.ranked_report(o, ["o_custkey"], "price_band")
    direct = windows.ranked_report_window(o, ["o_custkey"], "price_band")
    assert _rows(fast) == _rows(direct)


def test_range_method_splits_hot_group_with_many_values(spark):
    rows = [("hot", float(i % 997) if i % 13 else None, i) for i in range(3000)]
    rows += [(f"g{i % 50}", float(i % 7), 10_000 + i) for i in range(6000)]
    rows += [(None, 1.0, 20_000), (None, None, 20_001)]
    df = spark.createDataFrame(rows, "a string, v double, id long")
    names = ("mx", "dr", "rk")
    direct = windows.ranked_report_window(df, ["a"], "v", names)
    by_range = windows.ranked_report(df, ["a"], "v", names, method="range", partitions=8)
    assert _rows(by_range) == _rows(direct)
    assert _rows(windows.ranked_report(df, ["a"], "v", names)) == _rows(direct)
    # The hot group's distinct values are spread over several range partitions.
    counts = df.groupBy("a", "v").count().repartitionByRange(8, F.col("a").asc(), F.col("v").desc())
    spread = counts.where("a = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert spread > 1


def test_slices_of_odd_values(spark):
    """Infinities, NaN, nulls, one value only, and values that are no numbers."""
    inf, nan = float("inf"), float("nan")
    rows = [("x", v, i) for i, v in enumerate([1.0, inf, -inf, nan, None, 2.5, 2.5, nan])]
    rows += [("one", 3.0, 100 + i) for i in range(5)] + [("many", float(i * i % 5003), 200 + i) for i in range(4000)] + [("none", None, 9000)]
    df = spark.createDataFrame(rows, "a string, v double, id long")
    assert repr(_rows(windows.ranked_report(df, ["a"], "v"))) == repr(_rows(windows.ranked_report_window(df, ["a"], "v")))
    text = df.select("a", F.col("v").cast("string").alias("v"), "id")
    assert _rows(windows.ranked_report(text, ["a"], "v")) == _rows(windows.ranked_report_window(text, ["a"], "v"))


def test_hot_groups_apart(spark):
    """Hot groups (one of them with null keys) by slices, the others by the window; a bounded list of hot groups."""
    rows = [("hot", 1, float(i % 97) if i % 11 else None, i) for i in range(900)] + [(None, None, float(i % 9), 2000 + i) for i in range(300)]
    rows += [(f"g{i % 40}", i % 3, float(i % 5), 3000 + i) for i in range(600)] + [("nan", 0, float("nan"), 5000), ("nan", 0, None, 5001)]
    df = spark.createDataFrame(rows, "a string, b int, v double, id long").repartition(5)
    want = repr(_rows(windows.ranked_report_window(df, ["a", "b"], "v")))
    for hot_rows, hot_groups in ((200, 10), (200, 1), (1, 10_000), (10_000, 10)):
        got = windows.ranked_report(df, ["a", "b"], "v", method="hot", hot_rows=hot_rows, hot_groups=hot_groups)
        assert dict(got.dtypes)["rank"] == dict(got.dtypes)["dense_rank"] == "bigint"
        assert repr(_rows(got)) == want
    assert windows.ranked_report(df.limit(0), ["a", "b"], "v", method="hot").count() == 0
