"""Factorisation machine: the linear-time identity, held-out accuracy, odd documents."""

import zlib

import numpy as np
import pytest

from framewright.llm import quality_classifier as qc
from tests.conftest import SF01
from tests.llm import helpers


def test_score_equals_the_sum_over_pairs():
    dice = np.random.default_rng(0)
    m = qc.Machine(0.3, dice.normal(0, 1, qc.FEATURES).astype(np.float32), dice.normal(0, 0.3, (qc.FEATURES, qc.RANK)).astype(np.float32))
    at, x = dice.choice(qc.FEATURES, 12, replace=False), dice.normal(0, 1, 12).astype(np.float32)
    z = 0.3 + float(m.w[at] @ x) + sum(float(m.v[at[i]] @ m.v[at[j]]) * x[i] * x[j] for i in range(12) for j in range(i))
    assert m.score(at, x) == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-5)


def test_held_out_accuracy_and_inputs(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    model = qc.train(docs, labels)
    got = {r.doc_id: r for r in qc.score(docs, model).collect()}
    assert len(got) == docs.count()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1
    held = [(r.predicted, truth[i]) for i, r in got.items() if r.held_out and i in truth]
    assert np.mean([p == t for p, t in held]) >= 0.93
    # Neither the labels of held-out rows nor ids, languages or sources play a part in a score.
    from pyspark.sql import functions as F
    flipped = labels.withColumn("quality", F.when(qc.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    renamed = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string"))
    again = {r.doc_id: r.score for r in qc.score(renamed, qc.train(renamed, flipped)).collect()}
    assert again == pytest.approx({i: r.score for i, r in got.items()})


def test_odd_documents_and_no_labels(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(100, 130)] + [(None, 1, 0), (101, None, 0), (5, 0, 1), (5, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    docs = helpers.odd_docs(spark)
    rows = qc.score(docs, qc.train(docs, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 5}) == 1
    none = qc.train(docs, labels.limit(0))
    assert {r.score for r in qc.score(docs, none).collect()} == {0.5}
    assert qc.score(helpers.no_docs(spark), none).count() == 0
    bounded = qc.train(docs, labels, rows=3)
    assert bounded.w.any()


def test_rows_that_share_a_labelled_id_count_once(spark, monkeypatch):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(i % 20, f"text {i} of some words", i) for i in range(400)], "doc_id long, text string, n_chars long")
    plan, chosen = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, *a, **k: plan.append(df) or chosen(df, *a, **k))
    qc.train(docs, labels, rows=5)
    assert plan[0].count() == 5
