"""Minimum-cost-flow resharding.

Old shards hold bytes, new shards have capacities, and a byte that stays in its shard costs nothing
while a byte that moves costs one.  The flow with the least cost says how many bytes go from each old
shard to each new one.  It is carried out in blocks: an old shard is cut by document hash into blocks
of about ``BLOCK_BYTES``, laid in a row, and the row is divided by the flow; whole blocks go to one
shard and only the block at a border is cut between documents.  Then only the shards that gain or
lose documents are written again: the texts are shuffled once, by ranges of (shard, old shard, block).

Rows are hashed with their place in the scan, so that rows with one id and text are spread over blocks.  A
scan in another order gives another placement of the same kind; slots are numbered from what was placed.
"""

from __future__ import annotations

from math import ceil, log2
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from framewright.llm.common import RELEASE, broadcast_within, stored

#: Bytes of a block; with more than 2^MOST_BLOCKS such blocks they are made larger, so that the table of blocks stays small.
BLOCK_BYTES, MOST_BLOCKS = 1 << 20, 18
HASH_BITS = 48


def fewest_moves(sizes: list[int], capacities: list[int]) -> dict[tuple[int, int], int]:
    """Bytes to send from old shard i to new shard j: successive cheapest paths in the residual graph.

    The capacities must add up to the sizes.  The graph has a node per shard, never per document."""
    n, m = len(sizes), len(capacities)
    supply, room, flow = list(sizes), list(capacities), {}
    cost = lambda i, j: int(i != j)
    while any(supply):
        # Cheapest distance of every node from any old shard with bytes left (Bellman-Ford).
        far = {("o", i): 0 for i in range(n) if supply[i]}
        via: dict = {}
        changed = True
        while changed:
            changed = False
            for i in range(n):
                for j in range(m):
                    steps = [(("o", i), ("n", j), cost(i, j))]
                    if flow.get((i, j)):
                        steps.append((("n", j), ("o", i), -cost(i, j)))
                    for a, b, c in steps:
                        if a in far and far[a] + c < far.get(b, 1 << 60):
                            far[b], via[b], changed = far[a] + c, a, True
        at = min((("n", j) for j in range(m) if room[j]), key=lambda v: (far[v], v))
        path, end = [], at[1]
        while at in via:
            path.append((via[at], at))
            at = via[at]
        amount = min([supply[at[1]], room[end], *(flow[b[1], a[1]] for a, b in path if a[0] == "n")])
        for a, b in path:
            key = (a[1], b[1]) if a[0] == "o" else (b[1], a[1])
            flow[key] = flow.get(key, 0) + (amount if a[0] == "o" else -amount)
        supply[at[1]] -= amount
        room[end] -= amount
    return {k: v for k, v in sorted(flow.items()) if v}


def even(total: int, shards: int) -> list[int]:
    return [total * (j + 1) // shards - total * j // shards for j in range(shards)]


def _keyed(docs: DataFrame, old_shard: Column, *more: Column) -> DataFrame:
    """``doc_id, size, text_crc32, old_shard, h`` of every row, and the given columns."""
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), old_shard.cast("int").alias("old_shard"),
        F.shiftrightunsigned(F.xxhash64(docs["doc_id"], text, F.monotonically_increasing_id()), 64 - HASH_BITS).alias("h"), *more)


class Plan(NamedTuple):
    """What goes where: the flow, the cuts of each old shard's row of bytes, and the blocks in it."""
    flow: dict[tuple[int, int], int]
    cuts: DataFrame
    blocks: DataFrame

    @property
    def affected(self) -> list[int]:
        """Shards that gain or lose documents."""
        return sorted({s for pair in self.flow if pair[0] != pair[1] for s in pair})


def plan(docs: DataFrame, old_shard: Column, old_shards: int, capacities: list[float]) -> Plan:
    """The least flow from ``old_shard`` (a column with numbers below ``old_shards``) to new shards of the relative
    sizes ``capacities``.  A size is the UTF-8 bytes of the text (null: none) plus 8.  The number of shards is a
    parameter, so their sizes fit on the driver."""
    spark = docs.sparkSession
    rows = stored(_keyed(docs, old_shard).select("old_shard", "h", "size"), "reshard-sizes")
    held = {r["old_shard"]: r["b"] for r in rows.groupBy("old_shard").agg(F.sum("size").alias("b")).collect()}
    sizes = [held.get(i, 0) for i in range(old_shards)]
    total, scale = sum(sizes), sum(capacities)
    marks = [0]
    for c in capacities:
        marks.append(marks[-1] + c)
    caps = [int(total * b / scale) - int(total * a / scale) for a, b in zip(marks, marks[1:])]
    caps[-1] += total - sum(caps)
    flow = fewest_moves(sizes, caps)
    block_bytes = max(BLOCK_BYTES, total >> MOST_BLOCKS)
    # Each old shard's row of bytes: what stays first, then what goes, by new shard.
    found = []
    for i in range(old_shards):
        at, ends = 0, []
        for (_, j), amount in sorted(((k, v) for k, v in flow.items() if k[0] == i), key=lambda kv: (kv[0][1] != i, kv[0][1])):
            at += amount
            ends.append((at, j))
        bits = max(0, ceil(log2(max(1, sizes[i] / block_bytes))))
        found.append((i, HASH_BITS - bits, ends))
    cuts = spark.createDataFrame(found, "old_shard int, shift int, cuts array<struct<upto: long, shard: int>>")
    rows = rows.join(F.broadcast(cuts), "old_shard")
    sums = rows.groupBy("old_shard", F.expr("shiftright(h, shift)").alias("block"), "cuts").agg(F.sum("size").alias("bytes"))
    sums = sums.withColumn("before", F.sum("bytes").over(Window.partitionBy("old_shard").orderBy("block")) - F.col("bytes"))
    blocks = stored(sums.select("old_shard", "block", "before", _shard_of("before").alias("first_shard")), "reshard-blocks")
    return Plan(flow, cuts, broadcast_within(blocks, 32))


def _shard_of(place: str) -> Column:
    return F.expr(f"coalesce(try_element_at(filter(cuts, c -> {place} < c.upto), 1), element_at(cuts, -1)).shard")


def _placed(rows: DataFrame, plan: Plan) -> DataFrame:
    """Keyed rows with ``block``, ``shard`` and ``nth``, their place in the block.  One shuffle, by ranges that follow
    the new shards; a block is a small part of a shard whatever its rows are.  No row depends on the plan for being
    kept: blocks that a scan in another order makes anew begin where their old shard does."""
    rows = rows.join(F.broadcast(plan.cuts), "old_shard").withColumn("block", F.expr("shiftright(h, shift)"))
    rows = rows.join(plan.blocks, ["old_shard", "block"], "left").withColumns({
        "before": F.coalesce("before", F.lit(0)), "first_shard": F.coalesce("first_shard", F.expr("element_at(cuts, 1).shard"))})
    rows = rows.repartitionByRange("first_shard", "old_shard", "block")
    inside = Window.partitionBy("first_shard", "old_shard", "block").orderBy("h", "doc_id", "text_crc32", "size")
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("middle", F.col("before") + upto - F.col("size") / 2).withColumn("nth", F.row_number().over(inside).cast("long"))
    return rows.withColumn("shard", _shard_of("middle")).drop("shift", "cuts", "before", "first_shard", "middle", "h")


def _with_slots(placed: DataFrame) -> DataFrame:
    """Slots follow old shard and block; the rows that one shard has of a block follow each other in it."""
    counts = placed.groupBy("shard", "old_shard", "block").agg(F.count("*").alias("n"), F.min("nth").alias("first"))
    start = F.sum("n").over(Window.partitionBy("shard").orderBy("old_shard", "block")) - F.col("n") - F.col("first")
    starts = stored(counts.select("shard", "old_shard", "block", start.alias("start")), "reshard-starts")
    return placed.join(broadcast_within(starts, 40), ["shard", "old_shard", "block"]).select(
        "doc_id", "size", "text_crc32", "old_shard", "shard", (F.col("start") + F.col("nth")).alias("slot"))


def reshard(docs: DataFrame, old_shard: Column, old_shards: int, capacities: list[float]) -> DataFrame:
    """Where every document goes, without writing any: ``doc_id, size, text_crc32, old_shard, shard, slot``.

    Repeated rows are placed one by one; an empty table gives no rows.  See ``plan`` for the parameters."""
    found = plan(docs, old_shard, old_shards, capacities)
    return _with_slots(stored(_placed(_keyed(docs, old_shard), found), "reshard-placed"))


def own_names(docs: DataFrame) -> tuple[str, str]:
    """Names of the two columns that written shards have besides those of ``docs``: the shard (a folder) and the
    place, ``struct<old_shard, block, nth>``.  Underscores are added where ``docs`` has the name already."""
    taken, names = {c.lower() for c in docs.columns}, []
    for name in ("shard", "place"):
        while name in taken:
            name += "_"
        names.append(name)
    return names[0], names[1]


def rewrite(docs: DataFrame, old_shard: Column, found: Plan, folder: str) -> list[int]:
    """Write the documents of the affected shards to ``folder/shard=N`` with all their columns and their place;
    the files of the other shards stay as they are.  Returns the shards that were written.

    The texts of affected shards are shuffled once and never joined: a row's block comes from its hash, what a
    block does from the plan.  Documents of equal shards lie in few neighbouring tasks, so shards have few files."""
    shard, place = own_names(docs)
    every = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = _placed(_keyed(docs, old_shard, every).where(F.col("old_shard").isin(found.affected)), found)
    rows = rows.select("doc.*", F.struct("old_shard", "block", "nth").alias(place), F.col("shard").alias(shard))
    spark = docs.sparkSession
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        rows.write.partitionBy(shard).parquet(folder, compression="zstd")
    finally:
        spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)
    return found.affected


def resharded(docs: DataFrame, old_shard: Column, old_shards: int, capacities: list[float], folder: str) -> DataFrame:
    """Plan, rewrite, and read the result back: ``doc_id, size, text_crc32, old_shard, shard, slot`` as found in the files
    of the written shards, and in ``docs`` for those that stay."""
    found = plan(docs, old_shard, old_shards, capacities)
    shard, place = own_names(docs)
    written = rewrite(docs, old_shard, found, folder)
    stay = _placed(_keyed(docs, old_shard).where(~F.col("old_shard").isin(written)), found)
    if written:
        inner = StructType([StructField("old_shard", IntegerType()), StructField("block", LongType()), StructField("nth", LongType())])
        schema = StructType([*docs.schema.fields, StructField(place, inner), StructField(shard, IntegerType())])
        back = docs.sparkSession.read.schema(schema).parquet(folder)
        at = back[place]
        back = _keyed(back, at["old_shard"], at["block"].alias("block"), at["nth"].alias("nth"), back[shard].alias("shard")).drop("h")
        stay = back.unionByName(stay)
    return _with_slots(stored(stay, "reshard-placed"))
