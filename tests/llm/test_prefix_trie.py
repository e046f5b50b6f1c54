"""Prefix trie of conversations against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from framewright.llm import prefix_trie as pt
from tests.conftest import SF001, SF01
from tests.llm.helpers import WORDS

SCHEMA = "conv_id long, turn long, role string, text string, key string, node string, words string, slice string, h string"


def by_hand(rows) -> list[tuple]:
    """(conv_id, turn, role, text) rows; nodes as dictionary entries."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn, role or "", text or ""))
    md5 = lambda r, t: hashlib.md5(f"{len(r.encode())}:{r}{t}".encode()).hexdigest()
    for c, turns in convs.items():
        convs[c] = [(r, t) for _, r, t in sorted(turns, key=lambda x: (x[0] is not None, x[0] or 0, md5(x[1], x[2])))]
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(convs.get(c - c % 20, [])[:h] + own[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[b] for b in below) if below else 1
        own = (len(members[node]) - 1) * len(WORDS.findall(node[-1][1])) if node else 0
        saved[node] = own + sum(saved[b] for b in below)
    out = []
    for node, m in members.items():
        text = ",".join(map(str, sorted(ends.get(node, []))))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], saved[node],
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df) -> list[tuple]:
    return sorted((tuple(r[c] for c in pt.RESULT) for r in df.collect()), key=repr)


def _rows(df) -> list[tuple]:
    return [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]


def odd_rows() -> list[tuple]:
    dice = random.Random(8)
    said = [None, "", "  \t", "hello there", "ok\x1cthen", "a b c", "漢字 🙂", "word " * 3000]
    rows = []
    for c in [*range(0, 90), 1000, 1001, 1019, 2003, 2007]:
        for t in range(dice.choice([1, 2, 3, 4, 6])):
            rows.append((c, t, dice.choice(["user", "assistant", None]), dice.choice(said[:5])))
    same = [(0, "user", "hello there"), (1, "assistant", "a b c"), (2, "user", "ok")]
    for c in range(3000, 3100):                                        # many equal conversations
        rows += [(c, *x) for x in same]
    rows += [(50, None, "system", "null turn"), (51, 1, "user", "tie"), (51, 1, "user", "tie"), (51, 1, "assistant", "other tie")]
    rows += [rows[3], rows[7], (None, 0, "user", "nobody"), (None, None, None, None), (2009, 0, "user", said[-1])]
    rows += [(4000, t, "user", f"turn {t % 7}") for t in range(500)]    # one long conversation
    return rows


def _table(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA).repartition(3)


def test_small_tables(spark):
    for sf in (SF001, SF01):
        df = spark.read.parquet(f"{sf}/conversations.parquet")
        assert found(pt.conversation_trie(df)) == by_hand(_rows(df))


def test_odd_conversations(spark):
    rows = odd_rows()
    assert found(pt.conversation_trie(_table(spark, rows))) == by_hand(rows)


def test_slices_do_not_change_the_nodes(spark):
    """Nodes that reach over the ends of many slices, a hot first turn and a hot conversation among them."""
    rows = odd_rows()
    sequences = pt.rebuilt(pt.turn_sequences(_table(spark, rows)))
    for turns in (40, 200):
        assert found(pt.trie(sequences, slice_turns=turns)) == by_hand(rows)


def test_random_tries_in_many_slices(spark):
    for seed in range(3):
        dice = random.Random(seed)
        rows = [(c, t, "user", dice.choice(["x", "y y", "z z z"])) for c in range(120) for t in range(dice.randint(1, 5))]
        sequences = pt.rebuilt(pt.turn_sequences(_table(spark, rows)))
        assert found(pt.trie(sequences, slice_turns=30)) == by_hand(rows)


def test_turnless_conversations(spark):
    """Conversations whose own turns are all replaced and whose earlier one is absent."""
    rows = [(c, 0, "user", "x") for c in range(1, 20)]
    want = by_hand(rows)
    assert any(r[1] == 0 and r[3] == 19 for r in want)
    assert found(pt.conversation_trie(_table(spark, rows))) == want
    only = [(c, 0, "user", "x") for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4]
    assert found(pt.conversation_trie(_table(spark, only))) == by_hand(only)
    assert len(by_hand(only)) == 1


def test_no_conversations(spark):
    df = pt.conversation_trie(spark.createDataFrame([], SCHEMA))
    assert df.collect() == [] and tuple(df.columns) == pt.RESULT
    assert pt.conversation_trie(_table(spark, [(None, 1, "user", "x")])).collect() == []


def test_sparse_table_extents():
    dice = np.random.default_rng(2)
    for n in (1, 2, 3, 7, 64, 100):
        v = dice.integers(0, 6, n)
        v[0] = -1
        table = pt.SparseMin(v)
        for at in range(n):
            for d in range(0, 6):
                right = at + 1
                while right < n and v[right] >= d:
                    right += 1
                left = at
                while left > 0 and v[left] >= d:
                    left -= 1
                assert table.right_extent(np.array([at]), np.array([d]))[0] == right
                assert table.left_extent(np.array([at]), np.array([d]))[0] == left
        a, z = np.triu_indices(n, 0)
        assert table.least(a, z + 1).tolist() == [int(v[i:j + 1].min()) for i, j in zip(a, z)]


def test_a_hot_conversation_is_spread(spark):
    """A third of the conversations are equal: no slice holds much more than its share."""
    rows = spark.range(3000).select(F.col("id").alias("conv_id"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("turn"))
    rows = rows.select("conv_id", F.col("turn").cast("long"), F.lit("user").alias("role"),
                       F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit("same "), F.col("turn"))).otherwise(
                           F.concat(F.lit("turn "), F.col("conv_id") * 10 + F.col("turn"))).alias("text"))
    sequences = pt.turn_sequences(rows)
    keyed = pt._keyed(sequences)
    sizes = keyed.repartitionByRange(6, "key", "conv_id").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 3 * 500
    nodes = {(r.depth, r.conv_id): r for r in pt.trie(sequences, slice_turns=2000).collect()}
    hot = nodes[4, 0]
    assert hot.n_convs == 1000 and hot.n_leaves == 1 and hot.saved_tokens == 999 * 2
    assert hot.ends_sha256 == hashlib.sha256(",".join(str(i) for i in range(0, 3000, 3)).encode()).hexdigest()
    assert nodes[0, 0].n_convs == 3000 and nodes[0, 0].n_children == 2001 and nodes[0, 0].n_leaves == 2001
