"""Source mix: targets, nested thresholds, DuckDB, odd documents."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from framewright.llm import catalog, mixing
from tests.conftest import SF001
from tests.llm import helpers
from tests.oracle import compare, duck


def plain_targets(sizes: dict, weights=(5, 2, 1), share=1.5, most=2.0) -> dict:
    """Reshare the excess by weight until no target is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), share * sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        level = rest / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else level * weight[s] for s in names}
        full |= over


def test_targets_equal_the_stepwise_rule(spark):
    sizes = {"a": 100, "b": 5000, "c": 40, "d": 0, "e": 900, None: 333}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df, (5, 2, 1), 1.5, 2.0).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_matches_duckdb(spark):
    compare(catalog.op1_source_mix(spark, SF001), duck(SF001), mixing.SQL)


@pytest.mark.parametrize("docs", [helpers.odd_docs, helpers.small_docs])
def test_words_taken_come_near_the_targets(spark, docs):
    rows = mixing.mix(docs(spark)).collect()
    size, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        size[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert r.taken <= 2 * r.size and r.taken == r.size * r.copies
    for s, t in plain_targets(size).items():
        assert abs(taken[s] - t) <= 2 * largest[s] + 1
    again = {(r.doc_id, r.copies) for r in mixing.mix(docs(spark)).collect()}
    assert again == {(r.doc_id, r.copies) for r in rows}


def test_budgets_are_nested(spark):
    for r in mixing.mix(helpers.small_docs(spark), budgets=(1.5, 0.25, 0.8)).collect():
        assert r.copies_by_budget == sorted(r.copies_by_budget) and r.copies == r.copies_by_budget[-1]


def test_documents_of_the_mix_and_no_documents(spark):
    docs = helpers.odd_docs(spark)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    want = {r.doc_id: r.n for r in mixing.mix(docs).groupBy("doc_id").agg(F.sum("copies").alias("n")).collect() if r.n}
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == want
    assert mixing.mix(helpers.no_docs(spark)).count() == 0 and mixing.mixed_documents(helpers.no_docs(spark)).count() == 0
