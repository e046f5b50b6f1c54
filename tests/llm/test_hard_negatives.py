"""Hard negatives against all pairs."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from framewright.llm import hard_negatives as hn
from tests.conftest import SF01
from tests.llm.helpers import last_id
from tests.oracle import compare

SCHEMA = "vec_id long, embedding array<double>, label int, id string, key string, anchor string, q string, n string"


def by_hand(rows, positives=5, negatives=5, every=100):
    """(vec_id, embedding, label) rows; every pair of every anchor."""
    kept = []
    for i, v, y in rows:
        if y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        y = (y + 1) % 10 if i is not None and i % 7 == 0 else y
        kept.append((last_id(i), y, [min(max(math.floor(256 * x), -2**63), 2**63 - 1) for x in v]))
    out = []
    for k, (a, ya, va) in enumerate(kept):
        if a == last_id(None) or a % every:
            continue
        pairs = [(min(max(sum(x * y for x, y in zip(va, vb)), -2**63), 2**63 - 1), b, yb) for j, (b, yb, vb) in enumerate(kept) if j != k]
        same = sorted(((-s, b) for s, b, y in pairs if y == ya))[:positives]
        other = sorted((-s, b) for s, b, y in pairs if y != ya)
        for p, pid in same:
            window = [(-s, b) for s, b in other if 80 * -p <= 100 * -s <= 100 * -p][:negatives]
            out += [(a, pid, r, b, -p, s) for r, (s, b) in enumerate(window, 1)]
    return sorted(out)


def found(df):
    return sorted((r.anchor_id, last_id(r.positive_id), r["rank"], last_id(r.negative_id), r.positive_score, r.negative_score) for r in df.collect())


def _table(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA)


def test_small_table_equals_all_pairs(spark):
    e = spark.read.parquet(f"{SF01}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in e.collect()]
    want = by_hand(rows)
    assert want and found(hn.mined_embeddings(e.repartition(5))) == want


def test_oracle_sql(spark, duck01):
    compare(hn.mined_embeddings(spark.read.parquet(f"{SF01}/embeddings.parquet")), duck01, hn.SQL)


def test_ties_repeats_nulls_and_odd_vectors(spark):
    dice = random.Random(3)
    rows = [(i, [dice.choice([0.0, 0.25, 0.5]) for _ in range(4)], dice.randint(0, 3)) for i in range(0, 700, 10)]
    rows += [rows[0], rows[0], rows[10], rows[10], rows[12]]                         # repeated rows, also anchors
    rows += [(300, [0.5] * 4, 9), (300, [0.25] * 4, 9), (None, [0.5] * 4, 0), (None, [0.5] * 4, 1), (None, [0.5] * 4, 1)]
    rows += [(1, None, 1), (2, [0.1, None, 0.1, 0.1], 1), (3, [float("nan")] * 4, 1), (4, [float("inf")] * 4, 1), (5, [1.0] * 4, None)]
    rows += [(6, [], 1), (8, [0.5], 2), (9, [0.5] * 6, 2), (400, [], 3), (500, [-0.5] * 4, 1), (600, [0.5] * 7, 2)]
    df = _table(spark, rows).repartition(4)
    want = by_hand(rows)
    assert len(want) > 100 and found(hn.mined_embeddings(df)) == want


def test_huge_components(spark):
    rows = [(100 * i, [1e30 * (i - 1), 1.0], i % 2) for i in range(4)] + [(11 * i, [3e12 * i, 2e11 / i], i % 3) for i in range(1, 20)]
    assert found(hn.mined_embeddings(_table(spark, rows))) == by_hand(rows)


def test_no_rows_no_anchor_no_partner(spark):
    for rows in ([], [(1, [0.5], 1), (2, [0.5], 1)], [(100, [0.5], 1)], [(100, [0.5], 1), (1, [0.5], 1)], [(100, [0.5], 1), (1, [0.5], 2)]):
        df = hn.mined_embeddings(_table(spark, rows))
        assert df.collect() == []
        assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_chunks_and_other_limits_give_the_same_rows(spark):
    dice = random.Random(5)
    rows = [(i, [dice.uniform(0, 1) for _ in range(8)], dice.randint(0, 2)) for i in range(300)]
    df = _table(spark, rows).repartition(3)
    kept = hn.mining_rows(df, df["vec_id"], df["embedding"], hn.shifted_label(df["vec_id"], df["label"]))
    one = found(hn.mine(kept, lambda i: i % 10 == 0, positives=3, negatives=2))
    assert one == by_hand(rows, 3, 2, every=10)
    assert found(hn.mine(kept, lambda i: i % 10 == 0, positives=3, negatives=2, chunk=4)) == one


def test_a_third_of_the_rows_share_one_vector(spark):
    """The pairs sent per anchor are bounded by task, however many rows share its score."""
    base = spark.range(6000).select(
        F.col("id").alias("vec_id"), (F.col("id") % 5).cast("int").alias("label"),
        F.when(F.col("id") % 3 == 0, F.array(F.lit(0.5), F.lit(0.5))).otherwise(
            F.array((F.col("id") % 97) / 97, (F.col("id") % 89) / 89)).alias("embedding")).repartition(4)
    rows = hn.mining_rows(base, base["vec_id"], base["embedding"], hn.shifted_label(base["vec_id"], base["label"]))
    anchors = [r.asDict() | {"n": 1} for r in rows.where("id % 600 = 0").collect()]
    part = spark.sparkContext.broadcast(hn.Anchors(anchors))
    sent = hn.same_label_pairs(rows, part, 5).groupBy("anchor").count().collect()
    assert len(sent) == len(anchors) and max(r["count"] for r in sent) <= 6 * 4
    hand = by_hand([(r.vec_id, r.embedding, r.label) for r in base.collect()], every=600)
    assert found(hn.mine(rows, lambda i: i % 600 == 0)) == hand


def test_packed_keys_sort_like_their_parts():
    dice = random.Random(1)
    rows = [(dice.randint(0, 3), dice.choice([-2**63, -5, 0, 7, 2**63 - 1]), dice.randint(0, 1), dice.choice([-9, 0, 4, 2**63 - 1])) for _ in range(200)]
    a, s, k, i = (np.array(c) for c in zip(*rows))
    keys = hn.packed(a.astype(np.int64), s.astype(np.int64), k.astype(np.uint8), i.astype(np.int64)).column("key")
    assert list(hn.unpacked(keys)) == rows
    by_key = [r for _, r in sorted(zip(keys.to_pylist(), rows), key=lambda x: x[0])]
    assert by_key == sorted(rows, key=lambda r: (r[0], -r[1], r[2], r[3]))
