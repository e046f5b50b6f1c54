"""Aggregate properties and hand-written expectations."""

from pyspark.sql import functions as F

from framewright.operators import aggregate as agg
from framewright.operators import shared
from tests.conftest import SF01


def _li(spark):
    return spark.read.parquet(f"{SF01}/lineitem.parquet")


def test_rollup_rows_subset_of_cube(spark):
    li = _li(spark).select("l_returnflag", "l_linestatus", "l_quantity")
    keys = ["l_returnflag", "l_linestatus"]
    r = agg.rollup(li, keys, F.sum("l_quantity").alias("q"))
    c = agg.cube(li, keys, F.sum("l_quantity").alias("q"))
    assert set(map(tuple, r.collect())) <= set(map(tuple, c.collect()))
    assert r.where("grouping_id = 3").first()["q"] == li.agg(F.sum("l_quantity")).first()[0]


def test_grouping_sets_levels(spark):
    li = _li(spark).select("l_returnflag", "l_linestatus", "l_quantity")
    gs = agg.grouping_sets(li, [["l_returnflag"], ["l_linestatus"]], ["l_returnflag", "l_linestatus"],
                           F.count(F.lit(1)).alias("n"))
    levels = {r.grouping_id: r.cnt for r in gs.groupBy("grouping_id").agg(F.count(F.lit(1)).alias("cnt")).collect()}
    assert levels == {1: 3, 2: 2}


def test_approx_distinct_within_error(spark):
    li = _li(spark)
    row = li.agg(agg.approx_distinct("l_partkey", 0.1).alias("a"), F.count_distinct("l_partkey").alias("e")).first()
    assert abs(row.a - row.e) / row.e <= 0.3


def test_approx_quantiles_close_to_exact(spark):
    li = _li(spark)
    q = li.agg(agg.approx_quantiles("l_quantity", [0.5], 10_000).alias("q")).first().q[0]
    exact = li.agg(F.percentile("l_quantity", 0.5).alias("m")).first().m
    assert abs(q - exact) <= 1.0


def test_pivot_equals_conditional_sums(spark):
    li = _li(spark)
    p = agg.pivot(li, ["l_linestatus"], "l_returnflag", ["A", "N", "R"], F.sum("l_quantity"))
    c = li.groupBy("l_linestatus").agg(*[F.sum(F.when(F.col("l_returnflag") == v, F.col("l_quantity"))).alias(v)
                                         for v in ["A", "N", "R"]])
    assert sorted(map(tuple, p.collect())) == sorted(map(tuple, c.collect()))
    one = agg.pivot_values(li, ["l_linestatus"], "l_returnflag", ["A", "N", "R", "X"], F.sum, "l_quantity")
    spark_pivot = agg.pivot(li, ["l_linestatus"], "l_returnflag", ["A", "N", "R", "X"], F.sum("l_quantity"))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, spark_pivot.collect()))


def test_crosstab_wide_matches_spark_crosstab(spark):
    part = spark.read.parquet(f"{SF01}/part.parquet")
    types = [r.p_type for r in part.select("p_type").distinct().collect()]
    mine = agg.crosstab(part, "p_size", "p_type", sorted(types))
    theirs = part.stat.crosstab("p_size", "p_type")
    cols = ["p_size_p_type", *sorted(types)]
    to_set = lambda df: {(str(r[0]), *[int(r[c]) for c in cols[1:]]) for r in df.select(*cols).collect()}
    assert to_set(mine) == to_set(theirs)


def test_frequent_values_brute_force(spark):
    part = spark.read.parquet(f"{SF01}/part.parquet")
    got = {(r.p_brand, r.n) for r in agg.frequent_values(part, "p_brand", 0.04).collect()}
    rows = [r.p_brand for r in part.select("p_brand").collect()]
    exp = {(b, rows.count(b)) for b in set(rows) if rows.count(b) >= 0.04 * len(rows)}
    assert got == exp


def test_frequent_items_contains_true_heavy_hitters(spark):
    df = spark.createDataFrame([("a",)] * 60 + [("b",)] * 30 + [(str(i),) for i in range(10)], "x string")
    items = set(agg.frequent_items(df, ["x"], 0.25).first()[0])
    assert {"a", "b"} <= items


def test_describe_five_statistics(spark):
    d = agg.summary(spark.read.parquet(f"{SF01}/part.parquet"), "p_size")
    assert [r.summary for r in d.collect()] == ["count", "mean", "stddev", "min", "max"]


def test_counts_skip_nulls(spark):
    df = spark.createDataFrame([(1,), (None,), (1,), (2,)], "x int")
    r = df.agg(*agg.counts(df, "x")).first()
    assert (r.n_rows, r.n_x, r.n_distinct_x) == (4, 3, 2)


def test_first_last_by_is_repeatable(spark):
    df = spark.createDataFrame([("k", 3, "c"), ("k", 1, "a"), ("k", 2, "b")], "k string, o int, v string")
    r = df.groupBy("k").agg(*agg.first_last_by("v", "o", "v")).first()
    assert (r.v_first, r.v_last) == ("a", "c")


def test_two_sided_total_counts_row_twice(spark):
    trades = spark.createDataFrame(
        [("wool", "salt", 11), ("salt", "salt", 4), ("tin", "wool", 6), ("salt", "tin", 20)], "given string, got string, sacks long")
    totals = {r.entity: r.total for r in shared.two_sided_total(trades, "given", "got", "sacks").collect()}
    assert totals == {"wool": 17, "salt": 11 + 4 + 4 + 20, "tin": 26}
    assert shared.two_sided_total_for(trades, "given", "got", "sacks", "salt").first().total == totals["salt"]


def test_observed_side_metric(spark):
    trades = spark.createDataFrame([("wool", 11), ("tin", 6), ("wool", 2)], "given string, sacks long")
    df, obs = shared.observed(trades, "wool", F.sum(F.when(F.col("given") == "wool", F.col("sacks"))).alias("wool_sacks"))
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["wool_sacks"] == 13


def test_lookup_with_default(spark):
    birds = spark.createDataFrame([("wren",), ("heron",), ("wren",), (None,)], "bird string")
    out = shared.lookup_with_default(spark, birds, "bird", {"wren": 9, "owl": 41}, default=-1)
    assert sorted(((r.bird, r.value) for r in out.collect()), key=repr) == [("heron", -1), ("wren", 9), ("wren", 9), (None, -1)]


def test_sorted_list_of_pairs_bounded(spark):
    df = spark.createDataFrame([("n", "x")] * 500 + [("n", "y")] * 3, "k string, item string")
    r = agg.sorted_list_of_pairs(df, ["k"], "item").first()
    assert [(p.item, p.n) for p in r.item_counts] == [("x", 500), ("y", 3)]


def test_tree_sketches_within_error(spark):
    li = _li(spark)
    exact_d = li.agg(F.count_distinct("l_partkey")).first()[0]
    d = agg.approx_distinct_tree(li, "l_partkey", lg_k=12, buckets=4).first()[0]
    assert abs(d - exact_d) / exact_d <= 0.05
    q = agg.approx_quantiles_tree(li, "l_quantity", [0.5], k=400, buckets=4).first()[0][0]
    assert abs(q - li.agg(F.percentile("l_quantity", 0.5)).first()[0]) <= 1.0
