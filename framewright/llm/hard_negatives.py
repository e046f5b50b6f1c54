"""Hard-negative mining by a secondary sort.

Every pair score becomes a packed key (anchor, descending score, kind, id) whose bytes sort in that order; at
equal scores positives come first.  ``repartition`` by the anchor with ``sortWithinPartitions`` on
the key (the DataFrame form of repartitionAndSortWithinPartitions: one shuffle, sorted in each
partition, spilling) brings an anchor's pairs to one iterator in order.  The iterator opens a window at each
positive, hands the negatives that follow to the open windows, and closes a window when it is full or
when the scores have fallen under its lower end; an anchor's pairs are never held.

Not all pairs are sent.  A task scores its rows against the anchors as one matrix product and keeps, per
anchor, the best rows that can still count: of the same label the first ``POSITIVES`` + 1, and of
the others the first ``NEGATIVES`` of each positive's window.  That is exact, because a row among the first k
of all rows is among the first k of its own task.  The windows need the positives, so the rows are read
twice: once for the positives, once for the negatives.  Anchors are dealt by hash into chunks of about
``CHUNK`` rows, one chunk is broadcast at a time, and each chunk is a pass over the rows, so memory does
not grow with the number of anchors.

Defined results: rows without a label, without a vector or with a null or non-finite component take no
part; a row without an id is never an anchor, comes after all ids and is returned with a null id;
repeated rows are rows of their own, also as anchors; vectors of different lengths are compared as if
the shorter one ended in zeros; components and scores beyond a long are held at its limits.  An
anchor without positives, or a positive without negatives in its window, gives no rows; an empty table gives
none.  Other columns are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import LAST_ID, stored

#: Positives of an anchor, negatives of a positive, anchors of a broadcast chunk, anchors and rows of
#: one matrix product.
POSITIVES, NEGATIVES, CHUNK, ANCHOR_BLOCK, ROW_BLOCK = 5, 5, 16_384, 128, 8_192

_LEAST = np.iinfo(np.int64).min
_SIGN = np.uint64(1 << 63)
_KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])
_PAIRS = "anchor long, key binary"
SAME, OTHER, SELF = 0, 1, 2


def mining_rows(rows: DataFrame, vec_id: Column, embedding: Column, label: Column) -> DataFrame:
    """``id, label, q`` of the rows that take part; q holds floor(256 * component)."""
    v = embedding.cast("array<double>")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(label.isNotNull() & embedding.isNotNull() & whole).select(
        F.coalesce(vec_id.cast("long"), F.lit(LAST_ID)).alias("id"), label.cast("long").alias("label"),
        F.transform(v, lambda x: F.floor(x * 256)).alias("q"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as an int64 matrix, padded with zeros or cut to ``width`` (what a
    shorter partner would multiply by zero)."""
    flat, offsets = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy() - column.offsets[0].as_py()
    sizes = np.diff(offsets)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    for i, (a, z) in enumerate(zip(offsets[:-1], offsets[1:])):
        out[i, :min(z - a, width)] = flat[a:min(z, a + width)]
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    top = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * max(a.shape[1], 1)
    if top < 2.0 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    wide = a.astype(object) @ b.astype(object).T
    return np.clip(wide, _LEAST, LAST_ID).astype(np.int64)


class Anchors:
    """A chunk of distinct anchor rows, ordered by id, label and vector; ``times`` says how often each occurs."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: (r["id"], r["label"], r["q"]))
        self.width = max((len(r["q"]) for r in rows), default=0)
        self.ids = np.array([r["id"] for r in rows], np.int64)
        self.labels = np.array([r["label"] for r in rows], np.int64)
        self.sizes = np.array([len(r["q"]) for r in rows], np.int64)
        self.times = np.array([r["n"] for r in rows], np.int64)
        self.q = np.zeros((len(rows), self.width), np.int64)
        for i, r in enumerate(rows):
            self.q[i, :len(r["q"])] = r["q"]

    def copies(self, ids: np.ndarray, labels: np.ndarray, sizes: np.ndarray, q: np.ndarray) -> list[tuple[int, int]]:
        """(anchor, row) of the rows that are copies of an anchor (each anchor is one itself)."""
        out = []
        for r in np.flatnonzero(np.isin(ids, self.ids)):
            for a in range(*np.searchsorted(self.ids, [ids[r], ids[r] + 1 if ids[r] < LAST_ID else ids[r]])):
                if self.labels[a] == labels[r] and self.sizes[a] == sizes[r] and (self.q[a] == q[r]).all():
                    out.append((a, int(r)))
        return out


class Best:
    """The first ``k`` rows of each of ``n`` lists, by descending score and ascending id, over batches."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), _LEAST, np.int64)
        self.id, self.row, self.kind = np.full((n, k), LAST_ID, np.int64), np.full((n, k), -1, np.int64), np.zeros((n, k), np.uint8)

    def add(self, part: slice, score: np.ndarray, valid: np.ndarray, ids: np.ndarray, rows: np.ndarray, kinds: np.ndarray) -> None:
        """Scores of some lists against rows in ascending order of id; kinds per list and row."""
        k, width = min(self.k, score.shape[1]), score.shape[1]
        least = max(int(score.max()), -int(score.min()), 1)
        if least < (1 << 62) // width:
            # Unique keys: the score first, the smaller place next.
            keyed = np.where(valid, score * width + np.arange(width - 1, -1, -1), _LEAST)
            at = np.argpartition(keyed, width - k, axis=1)[:, width - k:] if k < width else np.broadcast_to(np.arange(width), score.shape)
        else:
            at = np.broadcast_to(np.arange(width), score.shape)
        take = lambda x: np.take_along_axis(x, at, axis=1)
        good = take(valid)
        score = np.concatenate([self.score[part], np.where(good, take(score), _LEAST)], axis=1)
        id_ = np.concatenate([self.id[part], np.where(good, ids[at], LAST_ID)], axis=1)
        row = np.concatenate([self.row[part], np.where(good, rows[at], -1)], axis=1)
        kind = np.concatenate([self.kind[part], take(kinds)], axis=1)
        # Descending score (bitwise complement: no overflow), empty places last, ascending id.
        first = np.lexsort((id_, row < 0, ~score), axis=1)[:, :self.k]
        for name, x in (("score", score), ("id", id_), ("row", row), ("kind", kind)):
            getattr(self, name)[part] = np.take_along_axis(x, first, axis=1)


def packed(anchor: np.ndarray, score: np.ndarray, kind: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """Pairs under keys whose bytes sort by anchor, descending score, positives first, id."""
    key = np.empty(len(anchor), _KEY)
    key["anchor"], key["kind"] = anchor.astype(np.uint64), kind
    key["score"] = (~score).view(np.uint64) ^ _SIGN
    key["id"] = ids.view(np.uint64) ^ _SIGN
    raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(_KEY.itemsize), len(key), [None, pa.py_buffer(key.tobytes())])
    return pa.RecordBatch.from_pydict({"anchor": pa.array(anchor, pa.int64()), "key": raw.cast(pa.binary())})


def unpacked(keys: pa.Array) -> Iterator[tuple[int, int, int, int]]:
    """(anchor, score, kind, id) of packed keys."""
    key = np.frombuffer(b"".join(keys.to_pylist()), _KEY)
    score = ~(key["score"].astype(np.uint64) ^ _SIGN).view(np.int64)
    ids = (key["id"].astype(np.uint64) ^ _SIGN).view(np.int64)
    return zip(key["anchor"].tolist(), score.tolist(), key["kind"].tolist(), ids.tolist())


def _row_blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple]:
    """Rows in blocks ordered by id: ids, labels, sizes, matrix, numbers within the task."""
    seen = 0
    for batch in batches:
        for a in range(0, batch.num_rows, ROW_BLOCK):
            b = batch.slice(a, ROW_BLOCK)
            ids = b.column("id").to_numpy()
            by = np.argsort(ids, kind="stable")
            lists = b.column("q")
            sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
            yield ids[by], b.column("label").to_numpy()[by], sizes[by], _matrix(lists, width)[by], seen + by
            seen += b.num_rows


def same_label_pairs(rows: DataFrame, chunk, positives: int) -> DataFrame:
    """Per task and anchor the first ``positives`` + 1 rows of its label, the anchor's copies marked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Anchors = chunk.value
        best = Best(len(anchors.ids), positives + 1)
        for ids, labels, sizes, q, number in _row_blocks(batches, anchors.width):
            own = {}
            for a, r in anchors.copies(ids, labels, sizes, q):
                own.setdefault(a // ANCHOR_BLOCK, []).append((a % ANCHOR_BLOCK, r))
            for at in range(0, len(anchors.ids), ANCHOR_BLOCK):
                part = slice(at, at + ANCHOR_BLOCK)
                score = _products(anchors.q[part], q)
                kinds = np.zeros(score.shape, np.uint8)
                for a, r in own.get(at // ANCHOR_BLOCK, ()):
                    kinds[a, r] = SELF
                best.add(part, score, anchors.labels[part, None] == labels[None, :], ids, number, kinds)
        a, k = np.nonzero(best.row >= 0)
        if len(a):
            yield packed(a, best.score[a, k], best.kind[a, k], best.id[a, k])
    return rows.mapInArrow(run, _PAIRS)


def other_label_pairs(rows: DataFrame, chunk, windows, negatives: int) -> DataFrame:
    """Per task, anchor and window the first ``negatives`` rows of other labels whose score lies in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Anchors = chunk.value
        low, high = windows.value
        best = [Best(len(anchors.ids), negatives) for _ in range(low.shape[1])]
        for ids, labels, _, q, number in _row_blocks(batches, anchors.width):
            for at in range(0, len(anchors.ids), ANCHOR_BLOCK):
                part = slice(at, at + ANCHOR_BLOCK)
                score = _products(anchors.q[part], q)
                other = anchors.labels[part, None] != labels[None, :]
                kinds = np.full(score.shape, OTHER, np.uint8)
                for w, b in enumerate(best):
                    inside = other & (score >= low[part, w, None]) & (score <= high[part, w, None])
                    if inside.any():
                        b.add(part, score, inside, ids, number, kinds)
        found = {}
        for b in best:
            for a, k in zip(*np.nonzero(b.row >= 0)):
                found[int(a), int(b.row[a, k])] = int(b.score[a, k]), int(b.id[a, k])
        if found:
            a = np.array([x for x, _ in found], np.int64)
            score, ids = (np.array(x, np.int64) for x in zip(*found.values()))
            yield packed(a, score, np.full(len(a), OTHER, np.uint8), ids)
    return rows.mapInArrow(run, _PAIRS)


def secondary_sorted(pairs: DataFrame) -> DataFrame:
    """Pairs dealt by anchor and sorted by their packed key inside each partition."""
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.repartition(parts, "anchor").sortWithinPartitions("key")


def _in_batches(rows: Iterator[tuple], names: list[str], size: int = 8192) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(names, zip(*held))})
            held = []
    if held:
        yield pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(names, zip(*held))})


def first_positives(pairs: DataFrame, positives: int) -> DataFrame:
    """``anchor, score, id``: the first rows of each anchor's label, itself left out once."""
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, taken, itself = None, 0, False
        for batch in batches:
            for anchor, score, kind, id_ in unpacked(batch.column("key")):
                if anchor != now:
                    now, taken, itself = anchor, 0, False
                if kind == SELF and not itself:
                    itself = True
                elif taken < positives:
                    taken += 1
                    yield anchor, score, id_

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _in_batches(walk(batches), ["anchor", "score", "id"])
    return secondary_sorted(pairs).mapInArrow(run, "anchor long, score long, id long")


def windowed_negatives(pairs: DataFrame, chunk, negatives: int) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from positives and
    negatives in order: a positive opens a window, the negatives that follow fill the open ones."""
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        anchors: Anchors = chunk.value
        now, open_ = None, []
        for batch in batches:
            for anchor, score, kind, id_ in unpacked(batch.column("key")):
                if anchor != now:
                    now, open_ = anchor, []
                if kind == SAME:
                    open_.append([score, id_, 0])
                    continue
                open_ = [w for w in open_ if w[2] < negatives and 100 * score >= 80 * w[0]]
                for w in open_:
                    w[2] += 1
                    for _ in range(int(anchors.times[anchor])):
                        yield int(anchors.ids[anchor]), w[1], w[2], id_, w[0], score

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _in_batches(walk(batches), names)
    return secondary_sorted(pairs).mapInArrow(run, ", ".join(f"{n} long" for n in names))


def positive_pairs(positives: DataFrame) -> DataFrame:
    """Positives under packed keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            anchor, score, ids = (b.column(c).to_numpy() for c in ("anchor", "score", "id"))
            yield packed(anchor, score, np.full(len(anchor), SAME, np.uint8), ids)
    return positives.mapInArrow(run, _PAIRS)


def _windows(positives: DataFrame, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper ends of the windows of a chunk's anchors; unused ones are empty."""
    low, high = np.full((n, width), LAST_ID, np.int64), np.full((n, width), _LEAST, np.int64)
    used = [0] * n
    for r in positives.collect():
        if r["score"] >= 0:            # under zero no score lies between 0.8 of it and itself
            low[r["anchor"], used[r["anchor"]]], high[r["anchor"], used[r["anchor"]]] = r["score"] - r["score"] // 5, r["score"]
            used[r["anchor"]] += 1
    return low, high


def mine(rows: DataFrame, is_anchor: Callable[[Column], Column], positives: int = POSITIVES,
         negatives: int = NEGATIVES, chunk: int = CHUNK) -> DataFrame:
    """Hard negatives of the anchors among ``id, label, q`` rows (see ``mining_rows``).

    A positive's negatives are the first ``negatives`` rows of other labels whose score is between 80 and
    100 per cent of the positive's."""
    spark, sc = rows.sparkSession, rows.sparkSession.sparkContext
    some = rows.where((F.col("id") != LAST_ID) & is_anchor(F.col("id")))
    anchors = stored(some.groupBy("id", "label", "q").agg(F.count(F.lit(1)).alias("n")), "anchors")
    chunks = max(1, -(-anchors.count() // chunk))
    anchors = anchors.withColumn("chunk", F.pmod(F.xxhash64("id", "label", "q"), F.lit(chunks)))
    out = None
    for c in range(chunks):
        held = Anchors(anchors.where(F.col("chunk") == c).collect())      # about ``chunk`` rows
        part = sc.broadcast(held)
        found = stored(first_positives(same_label_pairs(rows, part, positives), positives), "positives")
        windows = sc.broadcast(_windows(found, len(held.ids), positives))
        pairs = positive_pairs(found).unionByName(other_label_pairs(rows, part, windows, negatives))
        mined = stored(windowed_negatives(pairs, part, negatives), "hard-negatives")
        out = mined if out is None else out.unionByName(mined)
        windows.destroy()
        part.destroy()
    id_ = lambda c: F.when(F.col(c) != LAST_ID, F.col(c)).alias(c)
    return out.select("anchor_id", id_("positive_id"), F.col("rank").cast("int").alias("rank"), id_("negative_id"),
                      "positive_score", "negative_score")


def shifted_label(vec_id: Column, label: Column) -> Column:
    """The query's label: ids divisible by 7 move to the next of ten labels."""
    return F.when(F.coalesce(vec_id % 7 == 0, F.lit(False)), (label + 1) % 10).otherwise(label)


def mined_embeddings(embeddings: DataFrame) -> DataFrame:
    e = embeddings
    rows = mining_rows(e, e["vec_id"], e["embedding"], shifted_label(e["vec_id"], e["label"]))
    return mine(rows, lambda i: i % 100 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
       s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY rank <= 5
"""
