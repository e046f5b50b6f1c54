"""User-defined aggregates and table functions against brute force."""

import math
import random
from datetime import datetime, timedelta
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.functions.aggregates import Aggregate, GeometricMean, LargestMean, Slope, aggregate_by
from framewright.functions.tables import register_runs, value_runs


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def _table(n=900):
    """A hot key, null keys, ties, nulls, NaN, zeros and negative numbers."""
    dice = random.Random(11)
    value = lambda: dice.choice([None, float("nan"), 0.0, -2.5, 4.0, 4.0, dice.uniform(0.1, 900)])
    return [(dice.choice(["hot"] * 6 + ["a", "b", None]), dice.choice([1, None]), value(), value()) for _ in range(n)] + [("alone", 2, None, 1.0)]


def _expected(rows, k):
    here = [(y, x) for y, x in rows if y is not None and not math.isnan(y)]
    ys = [y for y, _ in here]
    top = sorted(ys, reverse=True)[:k]
    above = [math.log(y) for y in ys if y > 0]
    both = np.array([(y, x) for y, x in here if x is not None and not math.isnan(x)]).reshape(-1, 2)
    dx = both[:, 1] - both[:, 1].mean() if len(both) else np.zeros(0)
    flat = not len(dx) or not (dx * dx).sum()
    return (math.exp(sum(above) / len(above)) if above else None, sum(top) / len(top) if top else None,
            None if flat else float((dx * both[:, 0]).sum() / (dx * dx).sum()))


def _close(got, want):
    return all((a is None) == (b is None) and (a is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)) for a, b in zip(got, want, strict=True))


@pytest.mark.parametrize("held", [2, 1 << 17])
@pytest.mark.parametrize("keys", [["k", "j"], ["k"], []])
def test_aggregates_equal_brute_force(spark, small_batches, keys, held):
    rows = _table()
    df = spark.createDataFrame(rows, "k string, j int, y double, x double").repartition(6)
    got = aggregate_by(df, keys, {"g": (GeometricMean(), ["y"]), "t": (LargestMean(3), ["y"]), "s": (Slope(), ["y", "x"])}, held)
    assert got.columns == [*keys, "g", "t", "s"]
    found = {tuple(r)[:len(keys)]: tuple(r)[len(keys):] for r in got.collect()}
    groups = {}
    for r in rows:
        groups.setdefault(r[:len(keys)], []).append(r[2:])
    assert found.keys() == groups.keys()
    for key, some in groups.items():
        assert _close(found[key], _expected(some, 3)), key


def test_aggregate_of_nothing(spark):
    none = spark.createDataFrame([], "k string, y double")
    assert aggregate_by(none, ["k"], {"g": (GeometricMean(), ["y"])}).collect() == []
    assert [tuple(r) for r in aggregate_by(none, [], {"g": (GeometricMean(), ["y"]), "t": (LargestMean(2), ["y"])}).collect()] == [(None, None)]
    with pytest.raises(ValueError):
        LargestMean(0)


def test_keys_of_other_types_and_clashing_names(spark):
    """Times, dates, decimals and binary as keys; 0.0 and -0.0 are one key and so are NaNs; a key named like a state field."""
    when = datetime(2024, 3, 10, 2, 30)
    rows = [(when, when.date(), b"x", 0.0, 8.0), (when, when.date(), b"x", -0.0, 2.0), (None, None, None, float("nan"), 3.0), (None, None, None, float("nan"), 3.0)]
    df = spark.createDataFrame(rows, "`__k0` timestamp_ntz, `a.b` date, c binary, n double, y double").withColumn("d", F.col("y").cast("decimal(20,2)")).repartition(3)
    got = aggregate_by(df.withColumn("t", F.col("__k0").cast("timestamp")), ["__k0", "a.b", "c", "n", "t"], {"g": (GeometricMean(), ["d"])})
    found = {r[0]: (r[1], bytes(r[2]) if r[2] else None, round(r[5], 9)) for r in got.collect()}
    assert found == {when: (when.date(), b"x", 4.0), None: (None, None, 3.0)}
    by_decimal = aggregate_by(df, ["d"], {"g": (LargestMean(1), ["n"])}).collect()
    assert sorted(float(r[0]) for r in by_decimal) == [2.0, 3.0, 8.0]


def test_slope_keeps_digits(spark):
    """Large values that vary little: sums of squares would lose every digit."""
    df = spark.range(4000).select((F.col("id") % 3).alias("k"), (F.lit(1e9) + F.col("id") * 1e-3).alias("x"), (F.col("id") * 2e-3).alias("y")).repartition(7)
    for r in aggregate_by(df, ["k"], {"s": (Slope(), ["y", "x"])}).collect():
        assert math.isclose(r.s, 2.0, rel_tol=1e-3)


class Spread(Aggregate):
    """An aggregate made by a user: largest minus smallest, as a whole number."""

    state = "low double, high double"
    result = "long"

    def update(self, group, groups, values):
        x = values.to_numpy(zero_copy_only=False).astype(float)
        low, high = np.full(groups, np.inf), np.full(groups, -np.inf)
        np.minimum.at(low, group, x)
        np.maximum.at(high, group, x)
        return {"low": low, "high": high}

    def merge(self, starts, state):
        return {"low": np.minimum.reduceat(state["low"], starts), "high": np.maximum.reduceat(state["high"], starts)}

    def finish(self, state):
        import pyarrow as pa
        return pa.array((state["high"] - state["low"]).astype("int64"))


def test_an_aggregate_of_ones_own(spark):
    df = spark.range(1000).select((F.col("id") % 4).alias("k"), "id").repartition(5)
    assert sorted(map(tuple, aggregate_by(df, ["k"], {"w": (Spread(), ["id"])}).collect())) == [(k, 996) for k in range(4)]


def test_rows_are_not_shuffled(spark):
    """States go through the one exchange, at most one per task and key."""
    df = spark.range(0, 100_000, 1, 4).select(F.lit("hot").alias("k"), F.col("id").cast("double").alias("y"))
    out = aggregate_by(df, ["k"], {"g": (LargestMean(2), ["y"])})
    assert [tuple(r) for r in out.collect()] == [("hot", 99_998.5)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") == 1 and final.index("Exchange") < final.rindex("MapInArrow")


def _runs(rows):
    key = lambda r: (r[0] is not None, r[0] or "")
    out = []
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is not None, r[1] or datetime.min, r[2] is not None, r[2] or ""))
        for v, run in groupby(mine, key=lambda r: r[2]):
            run = list(run)
            out.append((k, v, run[0][1], run[-1][1], len(run)))
    return sorted(out, key=lambda r: (key(r), repr(r)))


@pytest.mark.parametrize("width", ["1 minute", "3 hours", "900 days"])
def test_runs_equal_brute_force(spark, small_batches, width):
    dice, start = random.Random(4), datetime(2024, 1, 1)
    rows = [(dice.choice(["hot", "hot", "hot", "a", None]), None if dice.random() < 0.05 else start + timedelta(minutes=dice.randint(0, 700)),
             dice.choice(["x", "x", "x", "y", None])) for _ in range(500)]
    rows += rows[:20] + [("one", start, "z")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "k string, t timestamp_ntz, v string, nth long").repartition(5)
    got = value_runs(df, ["k"], "t", "v", width, ("a", "z", "n"))
    assert got.columns == ["k", "v", "a", "z", "n"]
    assert sorted(map(tuple, got.collect()), key=lambda r: ((r[0] is not None, r[0] or ""), repr(tuple(r)))) == _runs(rows)


def test_runs_without_rows_keys_or_sql_names(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, None), (4, None), (5, 5)], "t long, v int")
    assert sorted(map(tuple, value_runs(df, [], "t", "v", 2).collect()), key=str) == [(5, 1, 2, 2), (5, 5, 5, 1), (None, 3, 4, 2)]
    assert value_runs(df.limit(0), [], "t", "v", 2).count() == 0
    keyed = df.withColumn("k", F.lit(1))
    name = register_runs(spark, "runs_of_five", keyed, ["k"], "t", "v")
    got = spark.sql(f"SELECT v, first, last, n FROM {name}(TABLE(SELECT * FROM {{rows}}) PARTITION BY k ORDER BY (t, v))", rows=keyed)
    assert sorted(map(tuple, got.collect()), key=str) == [(5, 1, 2, 2), (5, 5, 5, 1), (None, 3, 4, 2)]


@pytest.mark.parametrize("buckets", [1, 3])
def test_runs_of_many_keys_share_a_partition(spark, small_batches, monkeypatch, buckets):
    """Far more slices of keys than partitions of the table argument; batches end inside and between keys."""
    from framewright.functions import tables
    monkeypatch.setattr(tables, "BUCKETS", buckets)
    dice, start = random.Random(8), datetime(2024, 1, 1)
    rows = [(dice.choice([None, *map(str, range(90))]), None if dice.random() < 0.05 else start + timedelta(minutes=dice.randint(0, 700)),
             dice.choice(["x", "x", "y", None])) for _ in range(600)]
    rows += [("hot", start + timedelta(minutes=i), "xxxxy"[i % 5]) for i in range(60)]
    got = value_runs(spark.createDataFrame(rows, "k string, t timestamp_ntz, v string").repartition(4), ["k"], "t", "v", "3 hours")
    assert sorted(map(tuple, got.collect()), key=lambda r: ((r[0] is not None, r[0] or ""), repr(tuple(r)))) == _runs(rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    argument = plan[plan.index("ArrowEvalPythonUDTF"):].split("Exchange hashpartitioning(", 1)[1]
    assert "__k0" not in argument.split("),", 1)[0]


def test_runs_of_floats_and_nested_keys(spark, small_batches):
    """Within a run NaNs are equal and so are 0.0 and -0.0, at ends of batches too; keys may be structs."""
    values = [float("nan")] * 20 + [0.0, -0.0] * 10 + [None] * 9 + [float("nan")]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "t long, v double")
    got = value_runs(df.withColumn("k", F.struct(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b"))), ["k"], "t", "v", 1000)
    assert sorted((r.run_start, r.run_end, r.n_rows) for r in got.collect()) == [(0, 19, 20), (20, 39, 20), (40, 48, 9), (49, 49, 1)]
