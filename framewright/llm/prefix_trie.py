"""Conversation prefix trie from sorted turn sequences.

A conversation is the sequence of its turns' 128-bit hashes.  Conversations are sorted by that
sequence (a prefix before what extends it) and by id, by range, so each task holds a slice of the order.
In a slice the common prefix lengths (LCPs) of neighbours fill a sparse table for range minima.  A prefix of
depth d that starts in the slice at some conversation is a candidate; a binary search over the sparse table
finds, to the right and to the left independently, how far the LCPs stay at d or more.  The interval
between is the prefix's members; the left extent of the prefix one turn shorter names its parent.
There is no stack, and no candidate waits for another one.

Sums over a subtree are sums over the interval (prefix sums): members, words, newly started prefixes,
sequences that nothing extends.  They add up over slices, so a prefix whose interval touches an end of
its slice is finished by one small grouped sum over slices; whatever the slices' ends hide (a prefix
that the slice before has already, a last sequence that the next slice extends) is corrected by rows made from
the slices' first and last conversations.  All other nodes are finished inside their slice.  A group of
equal conversations, or a first turn that a third of them share, is thus spread over slices.

A conversation is one row of 16 bytes and a count per turn; texts are hashed where they are read and
never shuffled.

Defined results: turns without a conv_id belong to no conversation; a null role or text is empty; rows
of one conversation with equal turns are ordered by the hash of role and text, and repeated rows are
repeated turns; an empty table has no nodes.  Other columns are ignored, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import broadcast_within, n_words, stored

#: Bytes of a turn's hash; turns of a slice, about.
WIDTH, SLICE_TURNS = 16, 400_000

_DONE, _CHILD, _EDGE_NODE, _ENDS = 0, 1, 2, 3
_PARTS = ("kind int, slice int, node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
          "n_children long, n_leaves long, saved long, ends binary, first_key binary, first_words binary, last_key binary")


def turn_sequences(turns: DataFrame) -> DataFrame:
    """``conv_id, turns``: each conversation's turns in order, as an array of ``turn, h, w`` (number, hash
    of role and text in hex, words)."""
    role, text = (F.coalesce(turns[c].cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.where(turns["conv_id"].isNotNull()).select(
        turns["conv_id"].cast("long").alias("conv_id"), F.struct(turns["turn"].alias("turn"), digest.alias("h"), n_words(text).alias("w")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(sequences: DataFrame, every: int = 20, heads: int = 4) -> DataFrame:
    """Every conversation with its first turns taken from an earlier one: the first
    h = crc32(id) % ``heads`` turns of conversation id - id % ``every``, then its own after its first h."""
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    base = sequences.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, heads - 1).alias("head"))
    own = sequences.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    none = F.slice("turns", 1, 0)
    mixed = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
                     F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0))))
    return own.join(base, "base", "left").select("conv_id", mixed.alias("turns"))


def _keyed(sequences: DataFrame) -> DataFrame:
    """``conv_id, key, words``: the turns' hashes in a row, and the words of each turn."""
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["h"]), ""))
    return sequences.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["w"]).alias("words"))


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two sequences share at their starts."""
    n = min(len(a), len(b)) // WIDTH
    if a[:n * WIDTH] == b[:n * WIDTH]:
        return n
    x, y = (np.frombuffer(s, np.dtype((np.void, WIDTH)), n) for s in (a, b))
    return int((x != y).argmax())


class SparseMin:
    """Range minima: row k holds the minimum of 2^k numbers from each place on."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while len(self.rows[-1]) > 1 << (len(self.rows) - 1):
            last, step = self.rows[-1], 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(last[:-step], last[step:]))

    def least(self, a: np.ndarray, z: np.ndarray) -> np.ndarray:
        """Minimum of each half-open, non-empty range."""
        k = np.frexp((z - a).astype(np.float64))[1] - 1
        out = np.empty(len(a), self.rows[0].dtype)
        for level in np.unique(k):
            at = k == level
            row = self.rows[level]
            out[at] = np.minimum(row[a[at]], row[z[at] - (1 << int(level))])
        return out

    def right_extent(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """First place after each ``at`` whose value is under ``least``: binary steps from the top row."""
        z, n = at + 1, len(self.rows[0])
        for level in range(len(self.rows) - 1, -1, -1):
            row, step = self.rows[level], 1 << level
            fits = z + step <= n
            fits[fits] = row[z[fits]] >= least[fits]
            z = np.where(fits, z + step, z)
        return z

    def left_extent(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Least place p so that all values of (p, at] are at ``least`` or more."""
        a = at.copy()
        for level in range(len(self.rows) - 1, -1, -1):
            row, step = self.rows[level], 1 << level
            fits = a - step >= 0
            fits[fits] = row[a[fits] - step + 1] >= least[fits]
            a = np.where(fits, a - step, a)
        return a


def _prefix_ids(key: bytes, depths: set[int] | None = None) -> dict[int, bytes]:
    """Names of a sequence's prefixes by depth, from one running hash."""
    h, out = hashlib.blake2b(digest_size=16), {}
    for d in range(len(key) // WIDTH + 1):
        if d:
            h.update(key[(d - 1) * WIDTH:d * WIDTH])
        if depths is None or d in depths:
            out[d] = h.copy().digest()
    return out


def _hex(ids: np.ndarray) -> bytes:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest().encode()


def slice_nodes(convs: np.ndarray, keys: list[bytes], words: list[np.ndarray], number: int) -> pa.RecordBatch:
    """Rows of one slice of the sorted conversations (see the module notes)."""
    n = len(keys)
    lengths = np.array([len(k) // WIDTH for k in keys], np.int64)
    lcp = np.array([-1] + [common_turns(a, b) for a, b in zip(keys, keys[1:])], np.int64)
    table, ids = SparseMin(lcp), SparseMin(convs)
    # Words before each turn, all conversations in a row with one place more than turns.
    start = np.cumsum(lengths + 1) - (lengths + 1)
    before = np.zeros(int((lengths + 1).sum()), np.int64)
    for s, w in zip(start.tolist(), words):
        before[s + 1:s + 1 + len(w)] = np.cumsum(w)
    total = before[start + lengths]
    # Candidates: the prefixes that each conversation starts here.
    fresh = lengths - lcp
    rank = np.repeat(np.arange(n), fresh)
    depth = np.arange(len(rank)) - np.repeat(np.cumsum(fresh) - fresh, fresh) + lcp[rank] + 1
    left, right = table.left_extent(rank, depth), table.right_extent(rank, depth)
    members = right - left
    up = np.maximum(depth - 1, 0)
    words_all, words_new = np.r_[0, np.cumsum(total)], np.r_[0, np.cumsum(total - before[start + np.maximum(lcp, 0)])]
    through = words_all[right] - words_all[left] - members * before[start[rank] + up]
    own = words_new[right] - words_new[rank + 1] + total[rank] - before[start[rank] + np.maximum(up, np.maximum(lcp[rank], 0))]
    # A sequence that its neighbour to the right does not extend ends a leaf; the last one as if nothing came.
    leaf = np.r_[lcp[1:] < lengths[:-1], True].astype(np.int64)
    leaves = np.r_[0, np.cumsum(leaf)]
    n_leaves = leaves[right] - leaves[left]
    # The parent: the prefix one turn shorter, found at its own left extent.
    holder = table.left_extent(rank, up)
    first_of = np.cumsum(fresh) - fresh
    parent = np.where(depth > 0, first_of[holder] + up - lcp[holder] - 1, -1)
    n_children = np.bincount(parent[parent >= 0], minlength=len(rank))
    least = ids.least(left, right)
    edge = (left == 0) | (right == n)
    # Members that are the prefix itself: the run of equal sequences at its start.
    new = np.r_[True, (lcp[1:] < lengths[1:]) | (lengths[1:] != lengths[:-1])]
    last_same = (np.r_[np.flatnonzero(new)[1:], n] - 1)[np.cumsum(new) - 1]
    ends = [convs[r:last_same[r] + 1] if lengths[r] == d else convs[:0] for r, d in zip(rank.tolist(), depth.tolist())]
    wanted: dict[int, set[int]] = {}
    for i in np.flatnonzero(edge | (edge[parent] & (parent >= 0))).tolist():
        j = i if edge[i] else int(parent[i])
        wanted.setdefault(int(rank[j]), set()).update((int(depth[j]), max(int(depth[j]) - 1, 0)))
    names = {r: _prefix_ids(keys[r], d) for r, d in wanted.items()}
    kind = np.where(edge, _EDGE_NODE, np.where(edge[parent], _CHILD, _DONE))
    none = [None] * len(rank)
    cols: dict[str, list] = {"node": none.copy(), "parent": none.copy(), "ends": none.copy(), "parent_conv_id": none.copy()}
    for i, (k, r, d, p) in enumerate(zip(kind.tolist(), rank.tolist(), depth.tolist(), parent.tolist())):
        if k == _EDGE_NODE:
            cols["node"][i] = names[r][d]
            cols["parent"][i] = names[r][d - 1] if d else None
            cols["ends"][i] = ",".join(map(str, ends[i].tolist())).encode()
        else:
            if k == _CHILD:
                cols["parent"][i] = names[int(rank[p])][int(depth[p])]
            else:
                cols["parent_conv_id"][i] = int(least[p])
            cols["ends"][i] = _hex(ends[i])
    # One row more: the slice's ends.
    more = {"first_key": keys[0], "first_words": np.asarray(words[0], "<i8").tobytes(), "last_key": keys[-1]}
    numbers = {"conv_id": least, "depth": depth, "n_convs": members, "n_children": n_children, "n_leaves": n_leaves, "saved": through - own}
    out = {"kind": pa.array([*kind.tolist(), _ENDS], pa.int32()), "slice": pa.array([number] * (len(rank) + 1), pa.int32())}
    out |= {c: pa.array([*v, None], pa.int64() if c == "parent_conv_id" else pa.binary()) for c, v in cols.items()}
    out |= {c: pa.array([*v.tolist(), None], pa.int64()) for c, v in numbers.items()}
    out |= {c: pa.array([*none, v], pa.binary()) for c, v in more.items()}
    order = [x.split(" ")[0] for x in _PARTS.split(", ")]
    return pa.RecordBatch.from_pydict({c: out[c] for c in order})


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    convs, keys, words = [], [], []
    for b in batches:
        convs.append(b.column("conv_id").to_numpy())
        keys += b.column("key").to_pylist()
        lists = b.column("words")
        flat, cut = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        words += [flat[a:z] for a, z in zip(cut[:-1], cut[1:])]
    if keys:
        yield slice_nodes(np.concatenate(convs), keys, words, TaskContext.get().partitionId())


def _corrections(edges: DataFrame) -> DataFrame:
    """Rows of sums that take back what a slice could not know: prefixes of its first conversation that
    the slice before has, and a last sequence that the next slice has or extends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for r in b.to_pylist():
                if r["before_key"] is not None:
                    held = common_turns(r["before_key"], r["first_key"])
                    w = np.r_[0, np.cumsum(np.frombuffer(r["first_words"], "<i8"))]
                    for d, name in _prefix_ids(r["first_key"][:held * WIDTH]).items():
                        # Words counted as new again, and the child on this path.
                        out.append((name, -int(d < held), 0, int(w[held] - w[max(d - 1, 0)])))
                if r["after_key"] is not None and r["after_key"].startswith(r["last_key"]):
                    out += [(name, 0, -1, 0) for name in _prefix_ids(r["last_key"]).values()]
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.int64(), pa.int64()))],
                                             names=["node", "n_children", "n_leaves", "saved"])
    return edges.select("before_key", "first_key", "first_words", "last_key", "after_key").mapInArrow(
        run, "node binary, n_children long, n_leaves long, saved long")


def _hashed_ends(parts: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of nodes in several slices: their ids are hashed as they come, slice by slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h, any_ = None, None, False
        for b in batches:
            done = []
            for node, ends in zip(b.column("node").to_pylist(), b.column("ends").to_pylist()):
                if node != now:
                    if now is not None:
                        done.append((now, h.hexdigest()))
                    now, h, any_ = node, hashlib.sha256(), False
                if ends:
                    h.update(b"," + ends if any_ else ends)
                    any_ = True
            if done:
                yield pa.RecordBatch.from_pydict({"node": [x for x, _ in done], "ends_sha256": [x for _, x in done]})
        if now is not None:
            yield pa.RecordBatch.from_pydict({"node": [now], "ends_sha256": [h.hexdigest()]})
    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return parts.repartition(n, "node").sortWithinPartitions("node", "slice").select("node", "ends").mapInArrow(
        run, "node binary, ends_sha256 string")


RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie(sequences: DataFrame, slice_turns: int = SLICE_TURNS) -> DataFrame:
    """One row per node of the trie over ``conv_id, turns`` (see ``turn_sequences``): ``conv_id`` (least
    member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``,
    ``ends_sha256``."""
    spark = sequences.sparkSession
    rows = stored(_keyed(sequences), "turn-sequences")
    size = rows.agg(F.sum(F.size("words").cast("long") + 1).alias("n")).first()["n"] or 0
    slices = max(1, -(-size // slice_turns), min(int(spark.conf.get("spark.sql.shuffle.partitions")), size // 4096))
    sorted_ = rows.repartitionByRange(slices, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    parts = stored(sorted_.mapInArrow(_slices, _PARTS), "trie-parts")
    shared = parts.where(F.col("kind") == _EDGE_NODE)
    ends = parts.where(F.col("kind") == _ENDS).select("slice", "first_key", "first_words", "last_key")
    edges = stored(_with_neighbours(ends), "slice-ends")
    plain = shared.select("node", "parent", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved")
    fixes = _corrections(edges).select("node", F.lit(None).cast("binary").alias("parent"), F.lit(None).cast("long").alias("conv_id"),
                                       F.lit(None).cast("long").alias("depth"), F.lit(0).cast("long").alias("n_convs"),
                                       "n_children", "n_leaves", "saved")
    sums = plain.unionByName(fixes).groupBy("node").agg(
        F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")])
    joined = stored(sums.join(_hashed_ends(shared.select("node", "slice", "ends")), "node"), "shared-nodes")
    of_parent = broadcast_within(joined, 80).select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    inner = parts.where(F.col("kind") <= _CHILD).select(
        "kind", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved",
        F.col("ends").cast("string").alias("ends_sha256"))
    done = inner.where(F.col("kind") == _DONE).drop("kind", "parent")
    below = inner.where(F.col("kind") == _CHILD).drop("parent_conv_id").join(of_parent, "parent")
    top = joined.join(of_parent, "parent", "left")
    found = done.unionByName(below.withColumnRenamed("above", "parent_conv_id").drop("kind", "parent")).unionByName(
        top.withColumnRenamed("above", "parent_conv_id").drop("node", "parent"))
    return found.withColumnRenamed("saved", "saved_tokens").select(*RESULT)


def _with_neighbours(ends: DataFrame) -> DataFrame:
    """Each slice's ends with the last key before and the first key after it; empty slices are skipped by
    numbering those that have rows."""
    order = sorted(r["slice"] for r in ends.select("slice").collect())       # one number per slice
    places = ends.sparkSession.createDataFrame([(s, i) for i, s in enumerate(order)], "slice int, place int")
    rows = ends.join(F.broadcast(places), "slice")
    before = rows.select((F.col("place") + 1).alias("place"), F.col("last_key").alias("before_key"))
    after = rows.select((F.col("place") - 1).alias("place"), F.col("first_key").alias("after_key"))
    return rows.join(before, "place", "left").join(after, "place", "left")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations (the query's table)."""
    return trie(rebuilt(turn_sequences(conversations)))
