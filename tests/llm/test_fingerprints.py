"""Fingerprints: pairs, equality, estimates against exact likeness."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.llm import fingerprints as fp
from tests.llm import helpers
from tests.llm.helpers import WORDS


def shingles(text: str) -> set:
    w = WORDS.findall(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def exact(a: str, b: str) -> float:
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def ordered(docs) -> list[tuple]:
    hashed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    return [(r.doc_id, r.text) for r in sorted(hashed, key=lambda r: (r.doc_id is None, 0 if r.doc_id is None else -r.doc_id, r.h))]


def hot_docs(spark):
    """A third of the rows without an id, a third with one id, equal rows among both."""
    text = F.expr("concat_ws(' ', transform(sequence(1, 60), i -> concat('w', pmod(xxhash64(id, i), 500))))")
    own = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id") + 100)
    return spark.range(360).select(own.alias("doc_id"), F.when(F.col("id") % 12 < 2, F.repeat(F.lit("the same text of some words and "), 9)).otherwise(text).alias("text")).repartition(4)


@pytest.mark.parametrize("docs", [helpers.odd_docs, helpers.small_docs, hot_docs])
def test_rows_against_plain_python(spark, docs):
    docs = docs(spark)
    rows = ordered(docs)
    want = []
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), text, edited, following))
    got = fp.fingerprints(docs).collect()
    assert sorted(map(repr, ((r.doc_id, r.n_chars, r.edited_sha256) for r in got))) == sorted(repr(w[:3]) for w in want)
    prints, off = {}, []
    by = {(r.doc_id, r.edited_sha256): r for r in got}
    for i, _, sha, text, edited, following in want:
        r = by[i, sha]
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint        # equal texts
        assert r.fingerprint == fp.packed(fp.fingerprint(text)) and r.edited_fingerprint == fp.packed(fp.fingerprint(edited))
        off += [r.near_edited - exact(text, edited), r.near_next - exact(text, following)]
    assert np.mean(np.abs(off)) < 0.03 and abs(np.mean(off)) < 0.02 and max(map(abs, off)) < 0.35


def test_likeness_has_no_bias():
    dice = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.9):
        got = []
        for _ in range(60):
            n = 600
            both = int(2 * n * share / (1 + share))
            pool = dice.integers(0, (1 << 64) - 1, 2 * n, dtype=np.uint64)
            a, b = pool[:n], np.r_[pool[:both], pool[n:2 * n - both]]
            got.append(fp.likeness(fp.sketch(a), fp.sketch(b)))
        assert abs(np.mean(got) - share) < 0.015


def test_packing_and_empty_texts(spark):
    bits = fp.fingerprint("a few words of one short text")
    assert (fp.unpacked(fp.packed(bits)) == bits).all()
    assert fp.packed(None) == "" and fp.likeness(None, None) == 1.0 and fp.likeness(None, bits) == 0.0
    assert fp.fingerprints(helpers.no_docs(spark)).count() == 0
    lone = spark.createDataFrame([(1, "only one text here of some words")], "doc_id long, text string")
    r = fp.fingerprints(lone).first()
    assert r.near_next == 1.0 and r.doc_id == 1


def test_a_shared_id_is_split(spark):
    """Rows of one id, and equal rows, reach more than one task: several ranges have a first row of that id."""
    from framewright.llm import common
    mark = common.stored_count()
    assert fp.fingerprints(hot_docs(spark)).count() == 360
    folder = next(f for f in common.stored_since(mark) if "fingerprints" in f)
    heads = spark.read.parquet(folder).where("kind = 2")
    assert heads.where("doc_id IS NULL").count() > 1 and heads.where("doc_id = 7").count() > 1
