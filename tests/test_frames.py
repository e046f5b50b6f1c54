"""Range frames, offsets and row set operations against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from framewright.operators import aggregate, frames, setops


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _table(seed=3, n=400):
    dice = random.Random(seed)
    return [(i, dice.choice(["hot", "hot", "a", None]), None if dice.random() < 0.04 else dice.randint(0, 300), dice.choice([None, 1, 5, 7])) for i in range(n)]


@pytest.mark.parametrize("width", [3, 50, 10_000])
def test_range_frame_equals_brute_force(spark, width):
    rows = _table()
    df = spark.createDataFrame(rows + rows[:9], "i long, k string, t long, v long").repartition(4)
    got = frames.range_frame(df, ["k"], "t", 20, 5, {"n": ("count", F.lit(1)), "s": ("sum", F.col("v")), "m": ("max", F.col("v"))}, width)
    want = []
    for i, k, t, v in rows + rows[:9]:
        near = [x for _, l, u, x in rows + rows[:9] if l == k and None not in (t, u) and t - 20 <= u <= t + 5]
        some = [x for x in near if x is not None]
        want.append((i, k, t, v, len(near) if t is not None else None, sum(some) if some else None, max(some, default=None)))
    assert got.columns == ["i", "k", "t", "v", "n", "s", "m"] and _rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("offset", [1, 3, -1, -4])
@pytest.mark.parametrize("width", [2, 40, 10_000])
def test_shifted_equals_brute_force(spark, offset, width):
    """Offsets that reach over several short slices among them."""
    rows = _table(5)
    df = spark.createDataFrame(rows, "i long, k string, t long, v long").repartition(4)
    got = frames.shifted(df, ["k"], ["t", "i"], {"w": "v", "j": "i"}, offset, width)
    want = []
    for k in {r[1] for r in rows}:
        run = sorted((r for r in rows if r[1] == k), key=lambda r: (r[2] is not None, r[2] or 0, r[0]))
        for at, r in enumerate(run):
            other = run[at - offset] if 0 <= at - offset < len(run) else None
            want.append((*r, other and other[3], other and other[0]))
    assert _rows(got) == sorted(want, key=repr)
    with pytest.raises(ValueError):
        frames.shifted(df, ["k"], ["t", "i"], {"w": "v"}, 0, width)


def test_frames_of_nothing(spark):
    none = spark.createDataFrame([], "k string, t timestamp_ntz, v int")
    assert frames.range_frame(none, ["k"], "t", "1 hour", "0 hours", {"n": ("count", F.lit(1))}, "1 day").count() == 0
    assert frames.shifted(none, ["k"], ["t"], {"w": "v"}, 1, "1 day").count() == 0


def test_set_operations_with_nulls_repeats_and_a_hot_row(spark, monkeypatch):
    monkeypatch.setattr(setops, "_COPIES", 7)
    dice = random.Random(1)
    a = [(dice.choice([1, 2, 3, None]), dice.choice(["x", None])) for _ in range(90)] + [(9, "only left")] * 3 + [(5, "hot")] * 100
    b = [(dice.choice([1, 2, 4, None]), dice.choice(["x", None])) for _ in range(60)] + [(8, "only right")] + [(5, "hot")] * 63
    left = spark.createDataFrame(a, "n int, s string").repartition(3)
    right = spark.createDataFrame(b, "other long, name string").repartition(2)
    x, y = Counter(a), Counter(b)
    want = {(False, True): (x & y).elements(), (False, False): set(x) & set(y), (True, True): (x - y).elements(), (True, False): set(x) - set(y)}
    for (minus, all_), rows in want.items():
        got = (setops.except_ if minus else setops.intersect)(left, right, all_)
        assert got.columns == ["n", "s"] and _rows(got) == sorted(rows, key=repr)
    assert setops.intersect(left.limit(0), right).count() == 0 and _rows(setops.except_(left.limit(0), right, True)) == []
    with pytest.raises(ValueError):
        setops.intersect(left, right.select("name"))


def test_united_set_operations_are_read_by_separate_tasks(spark):
    """Operations that share one shuffle: a task of their union reads a part of it for one operation, not for all of them."""
    left, right = spark.range(500).selectExpr("id % 90 AS n", "id % 2 AS m"), spark.range(300).selectExpr("id % 120 AS n", "id % 2 AS m")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ops = [f(left, right, all_) for f in (setops.intersect, setops.except_) for all_ in (False, True)]
        assert setops.union_all(*ops).rdd.getNumPartitions() == sum(op.rdd.getNumPartitions() for op in ops) == 4 * 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_set_operations_on_floats_and_nested_rows(spark):
    """0.0 and -0.0 are equal and so are NaNs, within a struct too; columns of one name stay apart."""
    left = spark.createDataFrame([(0.0, (1, "a")), (float("nan"), None), (2.0, (1, None))], "x double, s struct<i:int,t:string>")
    right = spark.createDataFrame([(-0.0, (1, "a")), (float("nan"), None), (2.0, (2, None))], "x double, s struct<i:int,t:string>")
    assert sorted(str(r.x) for r in setops.intersect(left, right).collect()) == ["0.0", "nan"]
    assert _rows(setops.except_(left, right, True)) == [(2.0, (1, None))]
    twice = left.select("x", "x").where("x = 2")
    assert setops.intersect(twice, twice, True).columns == ["x", "x"] and setops.intersect(twice, twice, True).count() == 1


def test_pivot_values_are_bounded(spark):
    df = spark.range(50).withColumn("p", F.col("id") % 7)
    assert aggregate.values_of(df, "p", most=7) == list(range(7))
    with pytest.raises(ValueError, match="more than 6 values"):
        aggregate.values_of(df, "p", most=6)
