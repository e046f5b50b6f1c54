"""Resharding: least flow, near-equal shards, gapless slots, rewriting."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from framewright.llm import resharding as rs
from tests.llm import helpers


def test_flow_is_the_least():
    dice = random.Random(3)
    for _ in range(60):
        n, m = dice.randint(1, 7), dice.randint(1, 9)
        sizes = [dice.choice([0, dice.randint(0, 1000)]) for _ in range(n)]
        caps = rs.even(sum(sizes), m)
        flow = rs.fewest_moves(sizes, caps)
        assert [sum(v for (i, _), v in flow.items() if i == k) for k in range(n)] == sizes
        assert [sum(v for (_, j), v in flow.items() if j == k) for k in range(m)] == caps
        moved = sum(v for (i, j), v in flow.items() if i != j)
        # No plan keeps more than the smaller of a shard's bytes and its capacity.
        assert moved == sum(sizes) - sum(min(a, b) for a, b in zip(sizes, caps))


@pytest.mark.parametrize("block", [1 << 20, 4000])
@pytest.mark.parametrize("docs", [helpers.odd_docs, helpers.small_docs])
def test_placement(spark, docs, block, monkeypatch):
    monkeypatch.setattr(rs, "BLOCK_BYTES", block)
    docs = docs(spark)
    old = F.pmod(F.xxhash64(F.coalesce("source", F.lit("-"))), F.lit(5)).cast("int")
    placed = rs.reshard(docs, old, 5, [1] * 8).collect()
    texts = defaultdict(list)
    for i, t in helpers.rows_of(docs):
        texts[i].append((len(t.encode()) + 8, zlib.crc32(t.encode())))
    got, slots, size = defaultdict(list), defaultdict(list), [0] * 8
    for r in placed:
        got[r.doc_id].append((r.size, r.text_crc32))
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in texts.items()}
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    longest = max(s for v in texts.values() for s, _ in v)
    assert max(size) - min(size) <= 6 * longest            # a border cuts between documents


def test_shards_and_capacities(spark):
    rows = [(i, "x" * (i * 7919 % 300)) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("old", (F.col("doc_id") % 3).cast("int"))
    placed = rs.reshard(docs, F.col("old"), 3, [2, 1, 1])
    size = {r.shard: r.b for r in placed.groupBy("shard").agg(F.sum("size").alias("b")).collect()}
    total = sum(size.values())
    assert [size[j] / total for j in range(3)] == pytest.approx([0.5, 0.25, 0.25], abs=0.002)
    moved = placed.where("old_shard <> shard").agg(F.sum("size")).first()[0]
    held = {r.old_shard: r.b for r in placed.groupBy("old_shard").agg(F.sum("size").alias("b")).collect()}
    assert moved <= sum(max(0, held[j] - total * c) for j, c in enumerate((0.5, 0.25, 0.25))) + 6 * 308
    assert rs.reshard(helpers.no_docs(spark), F.lit(0), 1, [1, 1]).count() == 0


def test_only_affected_shards_are_written(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}" * 20, i % 4) for i in range(400)], "doc_id long, text string, old int")
    docs = docs.unionByName(docs.where("old = 3"))          # shard 3 holds too much
    found = rs.plan(docs, F.col("old"), 4, [1, 1, 1, 1])
    assert rs.rewrite(docs, F.col("old"), found, str(tmp_path / "out")) == [0, 1, 2, 3]
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 500 and back.drop("shard", "place").exceptAll(docs).count() == 0
    sizes = [97 * (1 + (i >= 200)) for i in range(300)]     # the first two shards are level, the others are not
    docs = spark.createDataFrame([(i, "é" * n, i // 100) for i, n in enumerate(sizes)], "doc_id long, text string, old int")
    level = sum(2 * n + 8 for n in sizes[:100])
    rest = sum(2 * n + 8 for n in sizes[200:])
    found = rs.plan(docs, F.col("old"), 3, [level, level, rest // 2, rest - rest // 2])
    assert found.affected == [2, 3]
    placed = rs.resharded(docs, F.col("old"), 3, [level, level, rest // 2, rest - rest // 2], str(tmp_path / "some")).collect()
    assert sorted(f.name for f in (tmp_path / "some").iterdir() if f.is_dir()) == ["shard=2", "shard=3"]
    assert sorted(r.doc_id for r in placed) == list(range(300)) and all(r.shard == r.old_shard for r in placed if r.old_shard < 2)
    for shard in range(4):
        assert sorted(r.slot for r in placed if r.shard == shard) == list(range(sum(r.shard == shard for r in placed)))


@pytest.mark.parametrize("docs", [helpers.odd_docs, helpers.small_docs, helpers.no_docs])
def test_written_shards_hold_every_row_and_column(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(rs, "BLOCK_BYTES", 4000)
    docs = docs(spark)
    docs = docs.withColumn("place", F.lit("mine")).withColumn("old_shard", F.lit(7)).withColumn("a.b", F.lit(1))
    old = F.pmod(F.xxhash64(F.coalesce("source", F.lit("-"))), F.lit(5)).cast("int")
    folder = str(tmp_path / "out")
    placed = rs.resharded(docs, old, 5, [1] * 8, folder)
    shard, place = rs.own_names(docs)
    got = Counter((r.doc_id, r.size, r.text_crc32) for r in placed.collect())
    assert got == Counter((i, len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in helpers.rows_of(docs))
    if not got:
        return
    assert place == "place_" and shard not in {c.lower() for c in docs.columns}
    back = spark.read.parquet(folder)
    assert back.drop(shard, place).exceptAll(docs).count() == 0 == docs.exceptAll(back.drop(shard, place)).count()
    in_files = Counter((r[0], r[1]) for r in back.select("doc_id", shard).collect())
    assert in_files == Counter((r.doc_id, r.shard) for r in placed.collect())
    slots = defaultdict(list)
    for r in placed.collect():
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_rows_that_are_equal_are_spread_over_blocks_and_shards(spark, monkeypatch):
    monkeypatch.setattr(rs, "BLOCK_BYTES", 2000)
    same = spark.range(0, 3000, 1, 4).select(F.lit(None).cast("long").alias("doc_id"), F.lit("the same text").alias("text"))
    found = rs.plan(same, F.lit(0), 2, [1] * 6)
    per_block = [r[0] for r in rs._placed(rs._keyed(same, F.lit(0)), found).groupBy("block").count().select("count").collect()]
    assert len(per_block) == 32 and max(per_block) < 200
    placed = rs.reshard(same, F.lit(0), 2, [1] * 6)
    counts = [r[0] for r in placed.groupBy("shard").count().select("count").collect()]
    assert len(counts) == 6 and max(counts) - min(counts) <= 1
    assert placed.select("shard", "slot").distinct().count() == 3000


def test_texts_are_shuffled_once(spark):
    docs = helpers.small_docs(spark)
    old = (F.col("doc_id") % 2).cast("int")
    found = rs.plan(docs, old, 2, [1, 1, 1])
    tree = rs._placed(rs._keyed(docs, old, F.col("text")), found)._jdf.queryExecution().executedPlan().toString()
    assert tree.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in tree


def test_blocks_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(rs, "BLOCK_BYTES", 100)
    monkeypatch.setattr(rs, "MOST_BLOCKS", 4)
    docs = spark.createDataFrame([(i, "x" * 92) for i in range(2000)], "doc_id long, text string")
    assert rs.plan(docs, F.lit(0), 1, [1, 1]).blocks.count() <= 32
