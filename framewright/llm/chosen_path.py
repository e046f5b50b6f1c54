"""Near-duplicates by a chosen-path set similarity join.

A document is its set of five-word shingles, embedded by ``COORDINATES`` minwise hashes.  In each of
``TREES`` independent trees a document goes down the branches that its own minwise tokens select: a
node looks at one coordinate, sometimes at a second one so that on average one shared branch is left for
similar documents, and sends a document to the child named by its token there.  Small nodes stop; large
ones branch again, up to ``DEPTH`` times.  Documents with equal sets are one class from the start.

Links are confirmed on full sets.  First every node's documents are held against its least one, which
joins groups of near copies in one linear step.  Then only nodes that hold several components are
searched exhaustively, between components, in blocks of bounded size.  A node of near copies never
becomes all of its pairs, and no partner is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import LAST_ID, WORDS, broadcast_within, release, stored, stored_count, stored_since
from framewright.llm.components import components
from framewright.llm.fingerprints import shingle_hashes, word_hashes

#: Least similarity in per cent; trees; coordinates; a node of so many documents is searched; levels;
#: documents of a block; estimated similarity from which sets are compared (six standard deviations
#: below the threshold for this number of coordinates: it loses 4e-8 of the pairs at the threshold).
PERCENT, TREES, COORDINATES, SMALL, DEPTH, BLOCK, LIKELY = 85, 12, 128, 256, 4, 512, 0.66

_FACTORS = np.random.default_rng(11).integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles, letters A-Z in lower case."""
    return np.unique(shingle_hashes(word_hashes(WORDS.findall(text.translate(_LOWER)))))


def minwise(s: np.ndarray) -> np.ndarray:
    out = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for k in range(0, len(s), 2048):
            part = (s[k:k + 2048, None] * _FACTORS) >> np.uint64(32)
            out = np.minimum(out, part.min(0).astype(np.uint32))
    return out


def _set_name(s: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return blake2b(s.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame) -> DataFrame:
    """``key, text_hash, n_shingles, name, sig``: name and sig are null for an empty set."""
    rows = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST_ID)).alias("key"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "key": b.column("key"), "text_hash": b.column("text_hash"), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "name": pa.array([_set_name(s) if len(s) else None for s in sets], pa.binary()),
                "sig": pa.array([minwise(s).tobytes() if len(s) else None for s in sets], pa.binary())})
    return rows.mapInArrow(run, "key long, text_hash long, n_shingles long, name binary, sig binary")


def _branches(node: Column) -> Column:
    """The coordinates a node looks at: one, and a second in the share that 1 / 0.85 asks for."""
    coordinate = lambda k: F.pmod(F.xxhash64(node, F.lit(k)), F.lit(COORDINATES)).cast("int")
    more = F.pmod(F.xxhash64(node, F.lit("more")), F.lit(1000)) < int(1000 * (100 / PERCENT - 1))
    return F.when(more, F.array_distinct(F.array(coordinate("a"), coordinate("b")))).otherwise(F.array(coordinate("a")))


def _children(rows: DataFrame) -> DataFrame:
    """``node, cls`` one level below the rows ``node, cls, sig``."""
    at = rows.select("cls", "sig", "node", F.explode(_branches(F.col("node"))).alias("c"))
    return at.select(F.xxhash64("node", "c", F.expr("substring(sig, 4 * c + 1, 4)")).alias("node"), "cls")


def tree_nodes(sigs: DataFrame) -> DataFrame:
    """Nodes with two or more documents at which the trees stop: ``node, n, cls``."""
    live = sigs.select("cls", "sig", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    live = stored(_children(live.select("cls", "sig", F.xxhash64(F.lit("root"), "tree").alias("node"))), "paths")
    found = None
    for level in range(1, DEPTH + 1):
        sizes = stored(live.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "node-sizes")
        stop = sizes if level == DEPTH else sizes.where(F.col("n") <= SMALL)
        leaves = live.join(broadcast_within(stop, 16), "node").select("node", "n", "cls")
        found = leaves if found is None else found.unionByName(leaves)
        large = sizes.where(F.col("n") > SMALL)
        if level == DEPTH or not large.count():
            break
        onward = live.join(broadcast_within(large, 16), "node").select("node", "cls")
        live = stored(_children(onward.join(sigs, "cls")), "paths")
    return found


def _by_group(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[int, pa.Table]]:
    """Groups of rows that arrive sorted by a column; a group may span batches."""
    rest: pa.Table | None = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        t = t if rest is None else pa.concat_tables([rest, t])
        ids = t.column(name).to_numpy()
        cut = np.flatnonzero(ids[1:] != ids[:-1]) + 1
        for a, z in zip(np.r_[0, cut][:-1], cut):
            yield int(ids[a]), t.slice(a, z - a)
        rest = t.slice(cut[-1] if len(cut) else 0)
    if rest is not None and rest.num_rows:
        yield int(rest.column(name)[0].as_py()), rest


def _sigs(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint32).reshape(t.num_rows, COORDINATES)


def _grouped(rows: DataFrame, by: str, *order: str) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, by).sortWithinPartitions(by, *order)


def star_pairs(nodes: DataFrame, sigs: DataFrame) -> DataFrame:
    """Pairs of each node's least document with those that look similar; large nodes in blocks, the
    least document in each of them."""
    leads = stored(nodes.groupBy("node").agg(F.min("cls").alias("lead"), F.max("n").alias("n")), "leads")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    part = lambda k: F.when(F.col("n") > BLOCK, F.xxhash64("node", k)).otherwise(F.col("node"))
    rows = nodes.select(part(F.pmod(F.xxhash64("cls"), blocks)).alias("node"), "cls", F.lit(1).alias("place"))
    first = leads.select(F.explode(F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1)).alias("k"), "node", "n", F.col("lead").alias("cls"))
    first = first.select(part(F.col("k")).alias("node"), "cls", F.lit(0).alias("place"))
    placed = rows.unionByName(first).groupBy("node", "cls").agg(F.min("place").alias("place")).join(sigs, "cls")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in _by_group(batches, "node"):
            if t.num_rows < 2:
                continue
            cls, sig = t.column("cls").to_numpy(), _sigs(t)
            near = np.flatnonzero((sig == sig[0]).mean(1) >= LIKELY)[1:]
            if len(near):
                yield pa.RecordBatch.from_pydict({"a": np.full(len(near), cls[0]), "b": cls[near]})

    return _grouped(placed, "node", "place").select("node", "cls", "sig").mapInArrow(run, "a long, b long").distinct()


def _in_blocks(rows: DataFrame) -> DataFrame:
    """``node, cls, root`` of mixed nodes, large ones in groups of at most about two blocks.

    The blocks of a node's largest component meet those of its other documents, and these each other; two
    blocks of the largest component never meet.  Documents of different components share a group."""
    sizes = rows.where(F.col("n") > BLOCK).groupBy("node", "root").agg(F.count(F.lit(1)).alias("size"))
    most = F.max(F.struct("size", "root")).alias("most")
    sizes = sizes.groupBy("node").agg(most, F.sum("size").alias("all")).select(
        "node", F.col("most.root").alias("largest"), F.ceil(F.col("most.size") / BLOCK).cast("int").alias("p"),
        F.ceil((F.col("all") - F.col("most.size")) / BLOCK).cast("int").alias("q"))
    rows = rows.join(broadcast_within(stored(sizes, "mixed-sizes"), 24), "node", "left")
    upto = lambda c, use: F.transform(F.sequence(F.lit(0), F.col(c) - 1), use)
    own = lambda c: F.pmod(F.xxhash64("cls"), F.col(c)).cast("int")
    largest = upto("q", lambda k: F.xxhash64("node", F.lit("largest"), own("p"), k))
    other = F.concat(upto("p", lambda k: F.xxhash64("node", F.lit("largest"), k, own("q"))),
                     upto("q", lambda k: F.xxhash64("node", F.lit("other"), F.least(own("q"), k), F.greatest(own("q"), k))))
    groups = F.when(F.col("p").isNull(), F.array("node")).when(F.col("root") == F.col("largest"), largest).otherwise(other)
    return rows.select(F.explode(groups).alias("node"), "cls", "root").distinct()


def mixed_groups(nodes: DataFrame, roots: DataFrame, sigs: DataFrame) -> DataFrame:
    """Documents of nodes that hold several components and look similar to one of another component:
    ``grp, cls, root``.  Groups with the same documents, from other trees, are one group."""
    rows = nodes.join(broadcast_within(roots, 24), nodes["cls"] == roots["vertex"], "left")
    rows = rows.select("node", "n", "cls", F.coalesce("root", "cls").alias("root"))
    several = stored(rows.groupBy("node").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.max("n").alias("m"))
                     .where("x <> y").select("node"), "mixed-nodes")
    rows = _in_blocks(rows.join(broadcast_within(several, 8), "node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in _by_group(batches, "node"):
            cls, root, sig = t.column("cls").to_numpy(), t.column("root").to_numpy(), _sigs(t)
            if len(np.unique(root)) < 2:
                continue
            some = np.zeros(len(cls), bool)
            for i in range(len(cls) - 1):
                near = np.flatnonzero(((sig[i + 1:] == sig[i]).mean(1) >= LIKELY) & (root[i + 1:] != root[i])) + i + 1
                if len(near):
                    some[i] = some[near] = True
            if some.any():
                which = np.sort(cls[some])
                grp = int.from_bytes(blake2b(which.tobytes(), digest_size=8).digest(), "little", signed=True)
                yield pa.RecordBatch.from_pydict({"grp": np.full(int(some.sum()), grp), "cls": cls[some], "root": root[some]})

    return _grouped(rows.join(sigs, "cls"), "node", "cls").select("node", "cls", "root", "sig").mapInArrow(
        run, "grp long, cls long, root long").distinct()


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``cls, shingles`` of the classes ``key, name, cls`` wanted, from one document of each."""
    rows = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST_ID)).alias("key"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    some = rows.join(broadcast_within(wanted.select("key").distinct(), 16), "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"name": pa.array([_set_name(s) for s in sets], pa.binary()),
                                              "shingles": pa.array([s.tobytes() for s in sets], pa.binary())})
    sets = some.select("text").mapInArrow(run, "name binary, shingles binary")
    return sets.join(broadcast_within(wanted.select("name", "cls"), 40), "name").select("cls", "shingles").dropDuplicates(["cls"])


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sets share ``percent`` per cent of their union; both sorted."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirmed_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left, right = sets.toDF("a", "sa"), sets.toDF("b", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            sa, sb = ([np.frombuffer(x.as_py(), np.uint64) for x in t.column(c)] for c in ("sa", "sb"))
            keep = pa.array([linked(x, y) for x, y in zip(sa, sb)], pa.bool_())
            yield t.select(["a", "b"]).filter(keep)
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def group_links(cls: np.ndarray, root: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links between documents of different components: one for each pair of components that has any.

    Documents are taken in order of size.  Each is held against all larger ones that its size allows in one
    step: the shingles of the group are numbered once, and one gather over the others' numbers
    counts what they share with it."""
    size = np.array([len(x) for x in sets])
    by = np.argsort(size, kind="stable")
    cls, root, size = cls[by], root[by], size[by]
    flat, numbers = np.unique(np.concatenate([sets[i] for i in by]), return_inverse=True)
    begin = np.r_[0, np.cumsum(size)]
    here = np.zeros(len(flat) + 1, bool)
    # The last document that 100 * smaller >= percent * larger allows.
    upto = np.searchsorted(size, size * 100 // percent, side="right")
    top: dict[int, int] = {}

    def find(v: int) -> int:
        while top.get(v, v) != v:
            top[v] = v = top.get(top[v], top[v])
        return v
    out = []
    for i in range(len(cls) - 1):
        if upto[i] <= i + 1:
            continue
        own = numbers[begin[i]:begin[i + 1]]
        here[own] = True
        a, z = begin[i + 1], begin[upto[i]]
        both = np.add.reduceat(here[numbers[a:z]], begin[i + 1:upto[i]] - a, dtype=np.int64)
        here[own] = False
        others = slice(i + 1, upto[i])
        hit = (100 * both >= percent * (size[i] + size[others] - both)) & (root[others] != root[i])
        for j in (np.flatnonzero(hit) + i + 1).tolist():
            x, y = find(int(root[i])), find(int(root[j]))
            if x != y:
                top[max(x, y)] = min(x, y)
                out.append((int(cls[i]), int(cls[j])))
    return out


def confirmed_groups(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Exhaustive search of the groups between components, on full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in _by_group(batches, "grp"):
            sets_ = [np.frombuffer(x.as_py(), np.uint64) for x in t.column("shingles")]
            out = group_links(t.column("cls").to_numpy(), t.column("root").to_numpy(), sets_)
            if out:
                a, b = zip(*out)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return _grouped(groups.join(sets, "cls"), "grp", "cls").select("grp", "cls", "root", "shingles").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: ``key, text_hash, n_shingles, component, kept``; key is the doc_id, with
    a null one last.

    A document without words is linked with nothing and kept.  Equal sets are linked.  Of repeated
    rows all are kept if one is.  An empty table gives no rows."""
    mark = stored_count()
    rows = stored(sketches(docs), "sketches")
    filled = rows.where(F.col("name").isNotNull())
    # Classes of equal sets are numbered once, in a table; the numbers stand for the 128-bit names from here on.
    classes = filled.groupBy("name").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("n"))
    classes = stored(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    sigs = filled.select("name", "key", "sig").join(broadcast_within(classes.select("name", "key", "cls"), 56), ["name", "key"])
    sigs = stored(sigs.select("cls", "sig").dropDuplicates(["cls"]), "signatures")
    nodes = stored(tree_nodes(sigs), "nodes")
    pairs = stored(star_pairs(nodes, sigs), "star-pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    sets = stored(full_sets(docs, ends.join(classes, "cls").select("key", "name", "cls")), "sets")
    links = stored(confirmed_pairs(pairs, sets), "links")
    roots = stored(components(links), "roots")
    groups = stored(mixed_groups(nodes, roots, sigs), "groups")
    more = full_sets(docs, groups.select("cls").distinct().join(classes, "cls").select("key", "name", "cls"))
    links = links.unionByName(stored(confirmed_groups(groups, more), "links"))
    roots = components(links)
    joined = classes.join(roots, classes["cls"] == roots["vertex"], "left")
    joined = stored(joined.select("name", "key", "n", F.coalesce("root", "cls").alias("root"), F.col("root").isNotNull().alias("linked")), "classes")
    least = joined.where("linked").groupBy("root").agg(F.min("key").alias("component"))
    groups_of = joined.where("linked").join(least, "root").select("name", "component")
    alone = joined.where("not linked and n > 1").select("name", F.col("key").alias("component"))
    found = stored(groups_of.unionByName(alone), "components")
    out = rows.drop("sig").join(broadcast_within(found, 32), "name", "left")
    component = F.coalesce("component", "key")
    out = out.select("key", "text_hash", "n_shingles", component.alias("component"), (F.col("key") == component).alias("kept"))
    release(stored_since(mark), out)                # all but the tables that the result reads
    return out


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents that stay, one of each group, with their own columns."""
    found = stored(near_duplicates(docs), "near-duplicates")
    out = found.where(~F.col("kept")).select("key", "text_hash").distinct()
    key = F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST_ID))
    text_hash = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    gone = broadcast_within(stored(out, "dropped"), 24)
    gone = gone.select(F.col("key").alias("__key"), F.col("text_hash").alias("__hash"))
    kept = docs.join(gone, (key == gone["__key"]) & (text_hash == gone["__hash"]), "left_anti")
    twins = found.where("kept").groupBy("key", "text_hash").count().where("count > 1").limit(1).count()
    return kept.dropDuplicates(["doc_id", "text"]) if twins else kept


def digest(docs: DataFrame) -> DataFrame:
    id_ = lambda c: F.when(F.col(c) != LAST_ID, F.col(c)).alias
    return near_duplicates(docs).select(id_("key")("doc_id"), "n_shingles", id_("component")("component_id"), "kept")
