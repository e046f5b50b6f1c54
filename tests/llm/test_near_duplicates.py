"""Near-duplicates against all pairs; components; large nodes."""

import random
from math import ceil, comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.llm import chosen_path as cp
from framewright.llm.components import components
from tests.llm import helpers
from tests.llm.helpers import WORDS


def shingles(text: str) -> frozenset:
    w = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def all_pairs(rows: list[tuple]) -> list[tuple]:
    sets, top = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(v):
        while top[v] != v:
            v = top[v]
        return v
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = find(i), find(j)
                top[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min(least.get(r, helpers.last_id(d)), helpers.last_id(d))
    none = lambda v: None if v == helpers.last_id(None) else v
    return sorted(((d, len(sets[i]), none(least[find(i)]), helpers.last_id(d) == least[find(i)]) for i, (d, _) in enumerate(rows)), key=repr)


def got(docs) -> list[tuple]:
    return sorted(map(tuple, cp.digest(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


@pytest.mark.parametrize("docs", [helpers.odd_docs, helpers.small_docs])
def test_equals_all_pairs(spark, docs):
    docs = docs(spark)
    assert got(docs) == all_pairs(helpers.rows_of(docs))


def drifting(n: int) -> list[tuple]:
    """Chains in which each text changes a little from the one before: links only between neighbours,
    all in large nodes; and copies."""
    dice = random.Random(6)
    rows, words = [], [f"w{dice.randint(0, 999)}" for _ in range(150)]
    for i in range(n):
        words = list(words)
        for _ in range(dice.choice([0, 1, 1, 2])):
            words[dice.randrange(150)] = f"n{dice.randint(0, 99999)}"
        if i % 40 == 39:
            words = [f"w{dice.randint(0, 999)}" for _ in range(150)]
        rows.append((i * 3, " ".join(words)))
    return rows


def test_large_nodes_in_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(cp, "SMALL", 8)
    monkeypatch.setattr(cp, "BLOCK", 12)
    monkeypatch.setattr(cp, "DEPTH", 2)
    rows = drifting(160)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(docs) == all_pairs(rows)


def mixed(spark, monkeypatch, roots: list[int]) -> dict[int, list]:
    """The groups that ``mixed_groups`` searches for one node whose documents have these components."""
    dealt, grouped = [], cp._grouped
    monkeypatch.setattr(cp, "BLOCK", 12)
    monkeypatch.setattr(cp, "_grouped", lambda rows, by, *order: dealt.append(rows) or grouped(rows, by, *order))
    nodes = spark.createDataFrame([(7, len(roots), i) for i in range(len(roots))], "node long, n long, cls long")
    tops = spark.createDataFrame(list(enumerate(roots)), "vertex long, root long")
    sigs = spark.createDataFrame([(i, bytes(4 * cp.COORDINATES)) for i in range(len(roots))], "cls long, sig binary")
    cp.mixed_groups(nodes, tops, sigs)
    found = {}
    for r in dealt[0].collect():
        found.setdefault(r.node, []).append(r.cls)
    return found


def test_one_stranger_does_not_make_a_node_quadratic(spark, monkeypatch):
    found = mixed(spark, monkeypatch, [0] * 600 + [600])
    assert sum(map(len, found.values())) <= 600 + 50 + 1 and all(600 in g for g in found.values())


def test_all_pairs_of_components_meet(spark, monkeypatch):
    dice = random.Random(9)
    roots = [dice.choice([0, 0, 0, 1, 2, 3]) for _ in range(150)]
    met = {(a, b) for g in mixed(spark, monkeypatch, roots).values() for a in g for b in g}
    assert all((a, b) in met for a in range(150) for b in range(a) if roots[a] != roots[b])


def test_the_filter_before_full_sets_loses_almost_nothing(spark):
    n, least = cp.COORDINATES, ceil(cp.LIKELY * cp.COORDINATES)
    assert sum(comb(n, i) * 0.85 ** i * 0.15 ** (n - i) for i in range(least)) < 1e-7
    sigs = spark.createDataFrame([(1, bytes(4 * n)), (2, bytes(4 * 90) + bytes([1]) * 4 * (n - 90))], "cls long, sig binary")
    nodes = spark.createDataFrame([(7, 2, 1), (7, 2, 2)], "node long, n long, cls long")
    assert [tuple(r) for r in cp.star_pairs(nodes, sigs).collect()] == [(1, 2)]


def test_one_of_each_group_stays(spark):
    docs = helpers.odd_docs(spark)
    kept = cp.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    want = {(d, c) for d, _, c, k in all_pairs(helpers.rows_of(docs)) if k}
    assert sorted(i for i in ids if i is not None) == sorted(d for d, _ in want if d is not None)
    assert cp.deduplicated(helpers.no_docs(spark)).count() == 0 and cp.digest(helpers.no_docs(spark)).count() == 0


def test_components_of_paths_and_stars(spark):
    dice = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(2000, 2000), (3001, 3000), (3000, 3001)]
    dice.shuffle(edges)
    found = {r.vertex: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(61)) and all(found[1000 + i] == 1000 for i in range(50))
    assert found[3001] == found[3000] == 3000 and 2000 not in found
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_group_links_equal_all_pairs():
    dice = np.random.default_rng(6)
    base = dice.integers(0, 1 << 62, 200, dtype=np.uint64)
    sets = []
    for _ in range(120):
        part = base[dice.random(200) < dice.choice([0.9, 0.97, 1.0])]
        sets.append(np.unique(np.r_[part, dice.integers(0, 1 << 62, dice.integers(0, 30), dtype=np.uint64)]))
    sets += [np.array([7], np.uint64), np.array([7, 8], np.uint64), sets[0]]
    cls = np.arange(len(sets)) * 3 + 1
    alone = cp.group_links(cls, cls, sets)

    def joined(links):
        top = {int(c): int(c) for c in cls}
        for a, b in links:
            a, b = top[a], top[b]
            top = {k: min(a, b) if v in (a, b) else v for k, v in top.items()}
        return top
    hand = [(int(cls[i]), int(cls[j])) for i in range(len(sets)) for j in range(i) if cp.linked(sets[i], sets[j])]
    assert hand and joined(alone) == joined(hand)
    root = np.where(cls % 2 == 0, 0, 1)              # two components: one link between them is enough
    assert len(cp.group_links(cls, root, sets)) == 1


def test_trees_keep_the_links_of_a_large_group(spark, monkeypatch):
    """2,000 near copies, whose nodes branch down to the fourth level: the pairs that are links share a node."""
    dice = random.Random(12)
    words = [f"w{i}" for i in range(260)]
    rows = []
    for i in range(2000):
        own = list(words)
        for k in dice.sample(range(260), dice.choice([1, 2, 3, 4])):
            own[k] = f"x{dice.randint(0, 10 ** 6)}"
        rows.append((i, " ".join(own)))
    levels = []
    keep = cp.stored
    monkeypatch.setattr(cp, "stored", lambda df, purpose, *a: (levels.append(purpose), keep(df, purpose, *a))[1])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sigs = keep(cp.sketches(docs).select(F.col("key").alias("cls"), "sig"), "test-signatures")
    nodes = cp.tree_nodes(sigs).select("node", "cls").toPandas()
    assert levels.count("paths") == cp.DEPTH
    together = np.zeros((2000, 2000), bool)
    for _, members in nodes.groupby("node")["cls"]:
        m = members.to_numpy()
        together[np.ix_(m, m)] = True
    sets = [cp.shingle_set(t) for _, t in rows]
    flat, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    holds = np.zeros((2000, len(flat)), np.float32)
    holds[np.repeat(np.arange(2000), [len(s) for s in sets]), numbers] = 1
    both = holds @ holds.T
    size = np.array([len(s) for s in sets])
    links = np.triu(100 * both >= 85 * (size[:, None] + size[None, :] - both), 1)
    assert links.sum() > 10_000
    recall = (links & together).sum() / links.sum()
    print(f"recall of {links.sum()} links at four levels: {recall:.5f}")
    assert recall >= 0.99
