"""Sorting, sampling, splitting, partitioning and union properties."""

from collections import Counter

from pyspark.sql import functions as F

from framewright.operators import aggregate as agg
from framewright.operators import ordering, setops
from tests.conftest import SF01


def _li(spark):
    return spark.read.parquet(f"{SF01}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity",
                                                                 "l_discount")


def test_split_parts_cover_input_disjointly(spark):
    li = _li(spark)
    a, b = ordering.random_split(li, [0.25, 0.75], seed=11)
    rows = lambda df: Counter(map(tuple, df.collect()))      # keys repeat in this data: whole-row multisets
    ra, rb = rows(a), rows(b)
    assert ra + rb == rows(li)
    assert 0.2 < sum(ra.values()) / li.count() < 0.3


def test_sample_repeatable_for_seed(spark):
    li = _li(spark)
    one = sorted(map(tuple, ordering.sample(li, 0.05, seed=3).collect()))
    two = sorted(map(tuple, ordering.sample(li, 0.05, seed=3).collect()))
    assert one == two and 0 < len(one) < li.count()


def test_union_count_adds(spark):
    li = _li(spark)
    assert setops.union_all(li, li, li).count() == 3 * li.count()
    swapped = li.select("l_linenumber", "l_orderkey", "l_quantity", "l_discount")
    by_pos = setops.union_all(li, swapped, by_name=False)
    by_name = setops.union_all(li, swapped, by_name=True)
    assert by_pos.count() == by_name.count()
    assert by_name.where(F.col("l_orderkey") == 0).count() == 2 * li.where(F.col("l_orderkey") == 0).count()


def test_top_k_total_order_and_partition_helpers(spark):
    li = _li(spark)
    top = ordering.top_k(li, 7, F.desc("l_quantity"), "l_orderkey", "l_linenumber").collect()
    full = sorted(li.collect(), key=lambda r: (-r.l_quantity, r.l_orderkey, r.l_linenumber))[:7]
    assert top == full
    assert ordering.repartition(li, 6, "l_orderkey").rdd.getNumPartitions() == 6
    assert ordering.coalesce(ordering.repartition(li, 6), 2).rdd.getNumPartitions() == 2
    within = ordering.sort_within_partitions(ordering.repartition(li, 3, "l_orderkey"), "l_quantity")
    for part in within.rdd.glom().collect():
        qs = [r.l_quantity for r in part]
        assert qs == sorted(qs)


def test_stat_forms_equal_aggregates(spark):
    li = _li(spark)
    assert abs(li.stat.corr("l_quantity", "l_discount")
               - li.agg(F.corr("l_quantity", "l_discount")).first()[0]) < 1e-12
    driver_q = li.approxQuantile("l_quantity", [0.25, 0.5], 0.001)
    agg_q = li.agg(agg.approx_quantiles("l_quantity", [0.25, 0.5], 1000)).first()[0]
    assert driver_q == agg_q


def test_cached_is_caller_owned(spark):
    li = ordering.cached(_li(spark))
    try:
        assert li.is_cached and li.count() > 0
    finally:
        li.unpersist()
