"""Property tests on random small tables with duplicate and null keys."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from framewright.operators import joins, windows

keys = st.one_of(st.none(), st.integers(min_value=0, max_value=4))
values = st.one_of(st.none(), st.integers(min_value=0, max_value=3).map(float))
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _bag(df):
    return Counter(map(tuple, df.collect()))


@SETTINGS
@given(left=st.lists(st.tuples(keys, st.integers(0, 9)), max_size=12),
       right=st.lists(st.tuples(keys, st.integers(0, 9)), max_size=12),
       how=st.sampled_from(["left", "right", "full"]))
def test_outer_join_forms_agree(spark, left, right, how):
    l = spark.createDataFrame(left, "lk int, lv int")
    r = spark.createDataFrame(right, "rk int, rv int")
    safe = joins.outer_join(l, r, [("lk", "rk")], how, skew_safe=True)
    plain = joins.outer_join(l, r, [("lk", "rk")], how, skew_safe=False)
    assert _bag(safe) == _bag(plain)


@SETTINGS
@given(left=st.lists(st.tuples(keys, st.integers(0, 9)), max_size=12),
       right=st.lists(st.tuples(keys,), max_size=12))
def test_semi_and_anti_agree_with_spark(spark, left, right):
    l = spark.createDataFrame(left, "k int, v int")
    r = spark.createDataFrame(right, "rk int")
    cond = l["k"] == r["rk"]
    assert _bag(joins.semi_join(l, r, [("k", "rk")])) == _bag(l.join(r, cond, "left_semi"))
    assert _bag(joins.anti_join(l, r, [("k", "rk")])) == _bag(l.join(r, cond, "left_anti"))


@SETTINGS
@given(rows=st.lists(st.tuples(keys, values, st.integers(0, 99)), min_size=1, max_size=25))
def test_ranked_report_methods_agree(spark, rows):
    df = spark.createDataFrame(rows, "g int, v double, id int")
    direct = _bag(windows.ranked_report_window(df, ["g"], "v"))
    assert _bag(windows.ranked_report(df, ["g"], "v")) == direct
    assert _bag(windows.ranked_report(df, ["g"], "v", method="range", partitions=3)) == direct
    assert _bag(windows.ranked_report(df, ["g"], "v", method="counts")) == direct
