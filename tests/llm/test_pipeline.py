"""The pipeline's stages in order, each against its operator's rules, and the entry module."""

from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipe
from framewright.llm.common import stored
from tests.conftest import SF001
from tests.llm import helpers
from tests.llm.test_near_duplicates import all_pairs


def test_entry_has_every_operator_and_the_pipeline():
    names = set(entry.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert [s for s, _ in pipe.STAGES] == ["quality rules", "near-dedup", "suffix-array dedup", "source mix", "best-fit packing"]


@pytest.mark.parametrize("docs", [helpers.odd_docs, helpers.small_docs])
def test_stages(spark, docs):
    docs = docs(spark)
    seen = [docs]
    for name, stage in pipe.STAGES[:-1]:
        seen.append(stored(stage(spark, seen[-1], SF001), "stage"))
        assert seen[-1].columns == docs.columns, name
    texts = [Counter(helpers.rows_of(d)) for d in seen]
    assert not texts[1] - texts[0] and not texts[2] - texts[1]              # two filters
    kept = Counter(d for d, _, _, k in all_pairs(helpers.rows_of(seen[1])) if k)
    assert Counter(i for i, _ in helpers.rows_of(seen[2]) if i is not None).keys() == {i for i in kept if i is not None}
    raws = [(helpers.last_id(i), t.encode()) for i, t in helpers.rows_of(seen[3])]
    assert {i for i, _ in helpers.rows_of(seen[3])} <= {i for i, _ in helpers.rows_of(seen[2])} and raws
    copies = Counter(i for i, _ in helpers.rows_of(seen[4]))
    base = Counter(i for i, _ in helpers.rows_of(seen[3]))
    assert all(n <= 2 * base[i] for i, n in copies.items())
    packed = pipe.STAGES[-1][1](spark, seen[4], SF001)
    assert Counter(r.doc_id for r in packed.where("piece = 0").collect()) == copies


def test_run_and_empty_input(spark):
    assert pipe.run(spark, SF001).count() > 0
    docs = helpers.no_docs(spark)
    for _, stage in pipe.STAGES:
        docs = stored(stage(spark, docs, SF001), "empty")
        assert docs.count() == 0
