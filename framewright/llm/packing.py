"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become token ids, the end id is added and texts over the capacity are cut into full
pieces (the first one takes the rest).  A full piece is a sequence of its own.  The other pieces are
spread by hash over shards of about ``SHARD_ITEMS`` pieces.  For each shard several islands evolve
packings of the same pieces: a crossover puts well-filled bins of one parent whole into the other,
bins that repeat a piece are dissolved and the displaced pieces are placed by best fit.  Between rounds
each island gets the elite of its neighbour; at the end the best packing of each shard stays.
Only piece numbers and lengths are shuffled.
"""

from __future__ import annotations

import random
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.bpe import PreTokens, Table
from framewright.llm.common import stored, texts

#: Pieces in a shard (mean), islands of a shard, rounds between migrations, crossovers of a round,
#: packings an island holds, entries of a worker's cache of pre-token ids.
SHARD_ITEMS, ISLANDS, ROUNDS, CROSSOVERS, POPULATION, CACHE_ENTRIES = 2048, 2, 2, 24, 5, 100_000

_WORKER: dict = {}


def _id_bytes(path: str) -> tuple[PreTokens, Table]:
    if path not in _WORKER:
        pre = PreTokens(path)
        _WORKER[path] = pre, Table({}, lambda t: array("I", pre.token_ids(t)).tobytes(), CACHE_ENTRIES)
    return _WORKER[path]


def cut(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Pieces of every document: ``doc_id, piece, start, length, ids_crc32``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre, table = _id_bytes(path)
        look, end = table.__getitem__, np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                runs = pre.runs(text)
                ids = (np.asarray(pre.whole_ids(text), "<u4").tobytes() if runs is None
                       else b"".join([b"".join(map(look, r)) for r in runs])) + end
                n, at, piece, view = len(ids) // 4, 0, 0, memoryview(ids)
                while at < n:
                    size = min(n, capacity) if at else n % capacity or capacity
                    out.append((doc, piece, at, size, zlib.crc32(view[4 * at:4 * (at + size)])))
                    at, piece = at + size, piece + 1
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return texts(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Packing:
    """Bins of piece numbers, with their fills."""

    def __init__(self, sizes: list[int], capacity: int, bins: list[list[int]]):
        self.sizes, self.capacity, self.bins = sizes, capacity, bins
        self.fills = [sum(sizes[i] for i in b) for b in bins]

    @property
    def cost(self) -> tuple[int, float]:
        """Fewer bins first; among equals, unequal fills, which leave usable room."""
        return len(self.bins), -sum(f * f for f in self.fills) / self.capacity ** 2

    def best_fit(self, items: list[int]) -> None:
        """Place pieces, longest first, where the least room stays; open bins as needed."""
        room = sorted((self.capacity - f, k) for k, f in enumerate(self.fills))
        for i in sorted(items, key=lambda i: (-self.sizes[i], i)):
            at = bisect_left(room, (self.sizes[i], -1))
            if at == len(room):
                self.bins.append([i])
                self.fills.append(self.sizes[i])
                insort(room, (self.capacity - self.sizes[i], len(self.bins) - 1))
            else:
                left, k = room.pop(at)
                self.bins[k].append(i)
                self.fills[k] += self.sizes[i]
                insort(room, (left - self.sizes[i], k))

    def labels(self) -> np.ndarray:
        out = np.empty(len(self.sizes), "<i4")
        for k, b in enumerate(self.bins):
            out[b] = k
        return out


def from_labels(sizes: list[int], capacity: int, labels: np.ndarray) -> Packing:
    bins: list[list[int]] = [[] for _ in range(int(labels.max()) + 1)] if len(labels) else []
    for i, k in enumerate(labels.tolist()):
        bins[k].append(i)
    return Packing(sizes, capacity, bins)


def crossover(a: Packing, b: Packing, dice: random.Random) -> Packing:
    """Well-filled bins of ``b`` go whole into ``a``; its bins that hold one of their pieces are
    dissolved, as are a few of its emptiest ones, and what they held beside is placed by best fit."""
    full = sorted(range(len(b.bins)), key=lambda k: -b.fills[k])
    full = full[:max(1, len(full) * 3 // 4)]
    given = [b.bins[k] for k in full if dice.random() < 0.4]
    inside = {i for bin_ in given for i in bin_}
    emptiest = set(sorted(range(len(a.bins)), key=lambda k: (a.fills[k], k))[:dice.randint(1, 4)])
    kept, displaced = [], []
    for k, bin_ in enumerate(a.bins):
        if k in emptiest or not inside.isdisjoint(bin_):
            displaced += [i for i in bin_ if i not in inside]
        else:
            kept.append(bin_)
    child = Packing(a.sizes, a.capacity, [list(x) for x in kept] + [list(x) for x in given])
    child.best_fit(displaced)
    return child


def evolve(sizes: list[int], capacity: int, seed: int, start: list[np.ndarray],
           crossovers: int = CROSSOVERS, population: int = POPULATION) -> Packing:
    """One island for one round; stops early at the lower bound on the number of bins."""
    dice = random.Random(seed)
    least = -(-sum(sizes) // capacity)
    people = [from_labels(sizes, capacity, x) for x in start]
    while len(people) < population:
        p = Packing(sizes, capacity, [])
        if not people and seed % ISLANDS == 0:
            p.best_fit(list(range(len(sizes))))
        else:                                       # best fit after a random part is laid first
            part = [i for i in range(len(sizes)) if dice.random() < 0.15]
            p.best_fit(part)
            chosen = set(part)
            p.best_fit([i for i in range(len(sizes)) if i not in chosen])
        people.append(p)
        if len(p.bins) <= least:
            return p
    for _ in range(crossovers):
        people.sort(key=lambda p: p.cost)
        if len(people[0].bins) <= least:
            break
        a, b = dice.sample(people[:max(2, population - 1)], 2)
        people[-1] = crossover(a, b, dice)
    return min(people, key=lambda p: p.cost)


def _ordered(items: pd.DataFrame) -> pd.DataFrame:
    return items.sort_values(["length", "uid"], ascending=[False, True], kind="stable").reset_index(drop=True)


def pack(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A null or empty text is the end id alone.  Repeated rows are packed once for each row.  An empty
    table gives no rows.  Sequence ids are unique numbers without meaning; offsets in a sequence are
    gapless from 0."""
    pieces = stored(cut(docs, path, capacity, end_id).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    whole = pieces.where(F.col("length") == capacity)
    items = pieces.where(F.col("length") < capacity)
    shards = max(1, -(-items.count() // SHARD_ITEMS))
    items = items.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)))
    lengths = items.select("shard", "uid", F.col("length").cast("int").alias("length"))
    kind = "shard long, island int, bins int, spread double, labels binary"

    def out(shard: int, island: int, p: Packing) -> pd.DataFrame:
        bins, spread = p.cost
        return pd.DataFrame({"shard": [shard], "island": [island], "bins": [bins], "spread": [spread], "labels": [p.labels().tobytes()]})

    def first(key, group: pd.DataFrame) -> pd.DataFrame:
        shard, island = int(key[0]), int(key[1])
        sizes = _ordered(group)["length"].tolist()
        return out(shard, island, evolve(sizes, capacity, shard * ISLANDS + island, []))

    def again(key, group: pd.DataFrame, elites: pd.DataFrame) -> pd.DataFrame:
        shard, island = int(key[0]), int(key[1])
        sizes = _ordered(group)["length"].tolist()
        start = [np.frombuffer(x, "<i4") for x in elites.sort_values(["bins", "spread", "island"])["labels"]]
        return out(shard, island, evolve(sizes, capacity, (shard + 1) * 7919 + island, start))

    def place(group: pd.DataFrame, best: pd.DataFrame) -> pd.DataFrame:
        group = _ordered(group)
        if not len(group):
            return group.assign(sequence_id=0, offset=0)[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]
        group["sequence_id"] = int(group["shard"].iloc[0]) * (1 << 32) + np.frombuffer(best["labels"].iloc[0], "<i4").astype("int64")
        group = group.sort_values(["sequence_id", "uid"], kind="stable")
        group["offset"] = group.groupby("sequence_id")["length"].cumsum() - group["length"]
        return group[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    spread_out = lengths.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
    elites = stored(spread_out.groupBy("shard", "island").applyInPandas(first, kind), "elites")
    for _ in range(ROUNDS - 1):
        moved = elites.withColumn("home", F.pmod(F.col("island") + 1, F.lit(ISLANDS)))      # ring of neighbours
        present = elites.withColumn("home", F.col("island")).unionByName(moved)
        elites = stored(
            spread_out.groupBy("shard", "island")
            .cogroup(present.withColumnRenamed("island", "origin").withColumnRenamed("home", "island")
                     .select("shard", "island", "bins", "spread", "labels").groupBy("shard", "island"))
            .applyInPandas(lambda k, g, e: again(k, g, e.assign(island=range(len(e)))), kind), "elites")
    best = elites.groupBy("shard").agg(F.min_by("labels", F.struct("bins", "spread", "island")).alias("labels"))
    result = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    placed = items.groupBy("shard").cogroup(best.groupBy("shard")).applyInPandas(place, result)
    alone = whole.select("doc_id", "piece", "start", "length", "ids_crc32",
                         (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.unionByName(alone)
