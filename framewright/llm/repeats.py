"""Repeated windows across documents: the dataflow that the suffix-array and the seed operators share.

1. Documents with equal texts are one: the one with the least id stands for them.
2. Every document gives the gram hashes of its anchors; hashes dealt to tasks show which anchors occur
   in two documents.
3. Only those come back to their documents, which send the block of each such anchor (its windows, as
   text) to the task of the anchor.  Equal windows have equal anchors, so they meet there.
4. The operator's own method finds, for every window of the blocks, the least id that has it.
5. Windows that a smaller id has are merged into spans, per document.

Ids: a null one comes after all others; rows with equal ids do not remove each other's windows.  What belongs
to a text is found again by a 128-bit hash of it and never by its id, so texts that share an id are not
mixed up, and the rows of one id are never gathered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm.anchors import blocks
from framewright.llm.common import BROADCAST_BYTES, LAST_ID, broadcast_within, discard, stored

#: Units of input text for a task of step 2, rows that step 4 handles at once (whole anchors).
TASK_BYTES, CHUNK_ROWS = 64 << 20, 60_000

#: units of a text, the text of a range of units, thresholds of blocks
Units = Callable[[str], tuple[np.ndarray, Callable[[int, int], bytes]]]
Thresholds = Callable[[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def key_of(docs: DataFrame) -> Column:
    return F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST_ID))


def text_hash(text: Column) -> list[Column]:
    """Two 64-bit hashes that name a text."""
    return [F.xxhash64(text).alias("x"), F.xxhash64(F.lit(1), text).alias("y")]


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(key_of(docs).alias("key"), *text_hash(text), text.alias("text"))


def copies(rows: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """One row of each text, the texts of several rows as ``x, y, first`` (least id), and the bytes of all texts."""
    marks = stored(rows.select("key", "x", "y", F.octet_length("text").alias("size")), "text-hashes")
    each = marks.groupBy("x", "y", "key").agg(F.count(F.lit(1)).alias("n"))
    least = each.groupBy("x", "y").agg(F.min(F.struct("key", "n")).alias("least"), F.sum("n").alias("n")).where("n > 1")
    several = stored(least.select("x", "y", F.col("least.key").alias("first"), (F.col("least.n") > 1).alias("twins")), "equal-texts")
    same = broadcast_within(several.select("x", "y", "first"), 24)
    joined = rows.join(same, ["x", "y"], "left")
    alone = joined.where(F.col("first").isNull() | (F.col("key") == F.col("first"))).drop("first")
    if several.where("twins").limit(1).count():         # rows that are equal in id and text
        alone = joined.where(F.col("first").isNull()).drop("first").unionByName(
            joined.where(F.col("key") == F.col("first")).drop("first").dropDuplicates(["x", "y"]))
    total = int(marks.agg(F.sum(F.col("size").cast("long"))).first()[0] or 0)
    discard(marks)
    return alone, several.select("x", "y", "first"), total


def _anchor_hashes(rows: DataFrame, units: Units, window: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, k = [], []
            for x, text in zip(b.column("x").to_pylist(), b.column("text").to_pylist()):
                u = units(text)[0]
                if len(u) >= window:
                    g = np.unique(blocks(u, window, gram)[0])
                    h.append(g)
                    k.append(np.full(len(g), x, np.int64))
            if h:
                yield pa.RecordBatch.from_pydict({"h": np.concatenate(h), "x": np.concatenate(k)})
    return rows.select("x", "text").mapInArrow(run, "h long, x long")


def _in_two(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the anchors that two different texts have."""
    parts = [(b.column("h").to_numpy(), b.column("x").to_numpy()) for b in batches]
    if not parts:
        return
    h, x = (np.concatenate(c) for c in zip(*parts))
    if not len(h):
        return
    order = np.lexsort((x, h))
    h, x = h[order], x[order]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    last = np.r_[first[1:], len(h)] - 1
    keep = np.repeat(x[first] != x[last], last - first + 1)
    h, x = h[keep], x[keep]
    for a in range(0, len(h), 1 << 16):
        yield pa.RecordBatch.from_pydict({"h": h[a:a + (1 << 16)], "x": x[a:a + (1 << 16)]})


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one: they are dealt by id once, and half as large."""
    for b in batches:
        raw = [t.encode("utf-8", "surrogatepass") for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_pydict({
            "key": b.column("key"), "x": b.column("x"), "y": b.column("y"), "size": pa.array([len(x) for x in raw], pa.int32()),
            "packed": pa.array([pa.compress(x, codec="zstd", asbytes=True) for x in raw], pa.binary())})


def _blocks_of(units: Units, window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set = set()
        for b in batches:
            found, text_of, ids, again = [], [], [], []
            wanted = b.column("hs")
            for i, (key, x_, y_, size, packed) in enumerate(zip(*(b.column(c).to_pylist() for c in ("key", "x", "y", "size", "packed")))):
                raw = pa.decompress(packed, decompressed_size=size, codec="zstd", asbytes=True)
                u, cut = units(raw.decode("utf-8", "surrogatepass"))
                g, f, s, n, o = blocks(u, window, gram)
                keep = np.isin(g, wanted[i].values.to_numpy(zero_copy_only=False))
                if not keep.any():
                    continue
                g, f, s, n, o = g[keep], f[keep], s[keep], n[keep], o[keep]
                # A block that a document holds several times is sent once, with its other places.
                by = np.lexsort((s, f, g))
                g, f, s, n, o = g[by], f[by], s[by], n[by], o[by]
                lead = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (f[1:] != f[:-1])])
                size = np.diff(np.r_[lead, len(g)])
                again += [s[a + 1:a + k].astype("<u4").tobytes() if k > 1 else None for a, k in zip(lead.tolist(), size.tolist())]
                g, f, s, n, o = g[lead], f[lead], s[lead], n[lead], o[lead]
                for x, a, z in zip(zip(g.tolist(), f.tolist()), s.tolist(), (s + n - 1 + window).tolist()):
                    if x in sent:
                        text_of.append(None)          # this task has sent the same block before
                    else:
                        if len(sent) > 500_000:
                            sent.clear()
                        sent.add(x)
                        text_of.append(cut(a, z))
                found.append((g, f, (s << 12) | (n << 6) | o))
                ids.append(np.tile(np.array([[key], [x_], [y_]], np.int64), len(g)))
            if found:
                g, f, at = (np.concatenate(x) for x in zip(*found))
                key, x_, y_ = np.concatenate(ids, axis=1)
                yield pa.RecordBatch.from_pydict({"h": g, "f": f, "key": key, "x": x_, "y": y_, "at": at,
                                                  "again": pa.array(again, pa.binary()), "block": pa.array(text_of, pa.binary())})
    return run


def _removed(table: pa.Table, window: int, thresholds: Thresholds) -> pa.RecordBatch | None:
    """Spans of the windows of some anchors' blocks that a smaller id has; rows sorted by h, f, key."""
    h, f, key, at = (table.column(c).to_numpy() for c in ("h", "f", "key", "at"))
    new = np.r_[True, (h[1:] != h[:-1]) | (f[1:] != f[:-1])]
    lead = np.flatnonzero(new)
    variant = np.cumsum(new) - 1
    texts = table.column("block").combine_chunks()
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks)
    full = np.flatnonzero(texts.is_valid().to_numpy(zero_copy_only=False))
    _, one = np.unique(variant[full], return_index=True)
    snippets = texts.take(pa.array(full[one])).to_pylist()
    count, off = (at[lead] >> 6) & 63, at[lead] & 63
    least = thresholds(h[lead], snippets, count, off, key[lead])
    t = least[variant]
    gone = (t < key[:, None]) & (np.arange(t.shape[1]) < ((at >> 6) & 63)[:, None])
    edge = np.zeros((len(key), t.shape[1] + 2), np.int8)
    edge[:, 1:-1] = gone
    step = np.diff(edge, axis=1)
    row, a = np.nonzero(step == 1)
    _, z = np.nonzero(step == -1)
    if not len(row):
        return None
    # Every place of the row's block: the first one and those that came along.
    others = [x or b"" for x in table.column("again").to_pylist()]
    many = np.array([len(x) // 4 for x in others]) + 1
    first = np.cumsum(many) - many
    places = np.empty(int(many.sum()), np.int64)
    places[first] = at >> 12
    rest = np.ones(len(places), bool)
    rest[first] = False
    places[rest] = np.frombuffer(b"".join(others), "<u4")
    each = np.repeat(np.arange(len(row)), many[row])
    nth = np.arange(len(each)) - np.repeat(np.cumsum(many[row]) - many[row], many[row])
    row, a, z = row[each], a[each], z[each]
    start = places[first[row] + nth]
    x, y = (table.column(c).to_numpy()[row] for c in ("x", "y"))
    return pa.RecordBatch.from_pydict({"x": x, "y": y, "a": start + a, "z": start + z - 1 + window})


def _judged(window: int, thresholds: Thresholds):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= CHUNK_ROWS:
                t = pa.Table.from_batches(held)
                h = t.column("h").to_numpy()
                cut = np.flatnonzero(h[1:] != h[:-1])
                if not len(cut):                    # one anchor so far
                    continue
                done = _removed(t.slice(0, cut[-1] + 1), window, thresholds)
                if done is not None:
                    yield done
                rest = t.slice(cut[-1] + 1).combine_chunks()
                held, n = rest.to_batches(), rest.num_rows
        if n:
            done = _removed(pa.Table.from_batches(held), window, thresholds)
            if done is not None:
                yield done
    return run


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of half-open spans."""
    order = np.argsort(starts, kind="stable")
    a, z = starts[order], np.maximum.accumulate(ends[order])
    new = np.r_[True, a[1:] > z[:-1]]
    return a[new], z[np.r_[np.flatnonzero(new)[1:] - 1, len(z) - 1]]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        spans = []
        for x in b.column("spans"):
            v = x.values
            spans.append(np.stack(merged(v.field("a").to_numpy(), v.field("z").to_numpy()), 1).astype("<i8").tobytes())
        yield pa.RecordBatch.from_pydict({"x": b.column("x"), "y": b.column("y"), "spans": pa.array(spans, pa.binary())})


def spans(docs: DataFrame, units: Units, window: int, gram: int, thresholds: Thresholds) -> tuple[DataFrame, DataFrame]:
    """``x, y, spans`` of the texts with repeated windows (int64 pairs, merged, in units), and
    ``x, y, first`` of the texts that several rows have."""
    spark = docs.sparkSession
    alone, same, total = copies(keyed(docs))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // TASK_BYTES)
    shared = _anchor_hashes(alone, units, window, gram).repartition(parts, "h").mapInArrow(_in_two, "h long, x long")
    # A text's list is bounded by its own anchors; the shuffle of all anchors ends with this table.
    wanted = stored(shared.groupBy("x").agg(F.collect_list("h").alias("hs")), "wanted")
    texts = alone.where(F.octet_length("text") >= window).mapInArrow(_squeezed, "key long, x long, y long, size int, packed binary")
    sent = texts.join(wanted, "x").select("key", "x", "y", "size", "packed", "hs").mapInArrow(
        _blocks_of(units, window, gram), "h long, f long, key long, x long, y long, at long, again binary, block binary")
    gone = sent.repartition(parts, "h").sortWithinPartitions("h", "f", "key").mapInArrow(
        _judged(window, thresholds), "x long, y long, a long, z long")
    found = gone.groupBy("x", "y").agg(F.collect_list(F.struct("a", "z")).alias("spans"))
    found = stored(found.mapInArrow(_merge, "x long, y long, spans binary"), "spans")
    discard(wanted)
    return found, same


def with_spans(docs: DataFrame, found: DataFrame, same: DataFrame) -> DataFrame:
    """``docs`` with ``__spans`` (null: none) and ``__copy`` (null: no whole copy)."""
    size = found.agg(F.sum(F.octet_length("spans").cast("long") + 32)).first()[0] or 0
    found = F.broadcast(found) if size <= BROADCAST_BYTES else found
    found = found.select(F.col("x").alias("__x"), F.col("y").alias("__y"), F.col("spans").alias("__spans"))
    same = broadcast_within(same, 24).select(F.col("x").alias("__cx"), F.col("y").alias("__cy"), F.col("first").alias("__first"))
    x, y = text_hash(F.coalesce(docs["text"], F.lit("")))
    rows = docs.withColumn("__hx", x).withColumn("__hy", y).withColumn("__key", key_of(docs))
    out = rows.join(found, (rows["__hx"] == found["__x"]) & (rows["__hy"] == found["__y"]), "left")
    out = out.join(same, (rows["__hx"] == same["__cx"]) & (rows["__hy"] == same["__cy"]), "left")
    out = out.withColumn("__copy", F.when(F.col("__key") > F.col("__first"), True))
    return out.drop("__x", "__y", "__cx", "__cy", "__hx", "__hy", "__key", "__first")
