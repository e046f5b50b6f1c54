"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score of a document with features x is ``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j`` through
the logistic function.  The pairwise part is half of ``sum_f (sum_i v_if x_i)^2 - sum_i (v_if x_i)^2``,
so a score takes time linear in the number of features.  The machine is fitted on at most
``TRAIN_ROWS`` labelled documents, chosen by hash among those the caller gives for training; every
document is scored, whole.  Inputs come from the text and its length column alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import WORDS
from framewright.llm.fingerprints import shingle_hashes, word_hashes

#: Bound on the labelled documents fitted on; hashed words; rank; passes; rows of a step.
TRAIN_ROWS, WORD_SLOTS, RANK, EPOCHS, BATCH = 6_000, 1 << 14, 8, 8, 64
RATE, DECAY, SEED = 0.15, 1e-4, 7

#: One-hot bins of each statistic, after the words.
BINS = 24
STATISTICS = ("words", "word length", "upper", "digit", "symbol", "other punctuation", "white space", "distinct words",
              "repeated lines", "repeated runs", "most frequent word", "line length", "length column")
FEATURES = WORD_SLOTS + BINS * len(STATISTICS)

# Byte classes: 1 upper case, 2 digit, 3 symbol, 4 other punctuation, 5 white space, 0 the rest.
_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91], _CLASS[48:58] = 1, 2
_CLASS[[ord(c) for c in "#*$%&|<>!=_~^\\{}[]@+"]] = 3
_CLASS[[ord(c) for c in ".,;:?'\"()-/`"]] = 4
_CLASS[[9, 10, 11, 12, 13, 32]] = 5


def _bin(x: float, per: float) -> int:
    return max(0, min(BINS - 1, int(x * per)))


def features(text: str, length: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of one document: words by log count with unit norm, one bin for
    each statistic.  Empty texts have the statistics alone."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = np.bincount(_CLASS[raw], minlength=6) / max(len(raw), 1)
    words = WORDS.findall(text)
    hashes = word_hashes(words)
    n = len(words)
    slots, counts = np.unique((hashes % np.uint64(WORD_SLOTS)).astype(np.int32), return_counts=True)
    values = np.log1p(counts).astype(np.float32)
    if n:
        values /= np.sqrt((values * values).sum())
    lines = [x for x in text.split("\n") if x]
    runs = shingle_hashes(hashes, 3)
    stats = (
        _bin(np.log2(n + 1), 1.5), _bin(sum(map(len, words)) / n if n else 0, 1.5), _bin(kinds[1] ** 0.5, BINS), _bin(kinds[2] ** 0.5, BINS),
        _bin(kinds[3] ** 0.5, BINS), _bin(kinds[4] ** 0.5, BINS), _bin(kinds[5] ** 0.5, BINS), _bin(len(set(words)) / n if n else 0, BINS),
        _bin(1 - len(set(lines)) / len(lines) if lines else 0, BINS), _bin(1 - len(np.unique(runs)) / len(runs) if len(runs) else 0, BINS),
        _bin((counts.max() / n) ** 0.5 if n else 0, BINS), _bin(np.log2(len(text) / max(len(lines), 1) + 1), 1.5),
        BINS - 1 if length is None else _bin(np.log2(max(length, 0) + 1), 1.0))
    at = WORD_SLOTS + BINS * np.arange(len(stats), dtype=np.int32) + np.asarray(stats, np.int32)
    share = np.float32(1 / np.sqrt(len(stats)))
    return np.r_[slots, at].astype(np.int32), np.r_[values, np.full(len(stats), share)].astype(np.float32)


class Machine:
    """Weights of the factorisation machine."""

    def __init__(self, w0: float, w: np.ndarray, v: np.ndarray):
        self.w0, self.w, self.v = w0, w, v

    def score(self, at: np.ndarray, x: np.ndarray) -> float:
        vx = self.v[at] * x[:, None]
        total = vx.sum(0)
        z = self.w0 + float(self.w[at] @ x) + 0.5 * float((total * total - (vx * vx).sum(0)).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Machine:
    """Logistic loss with balanced classes, minibatch steps with per-weight rates (Adagrad)."""
    dice = np.random.default_rng(SEED)
    w0, g0 = 0.0, 1e-6
    w, v = np.zeros(FEATURES, np.float32), dice.normal(0, 0.05, (FEATURES, RANK)).astype(np.float32)
    gw, gv = np.full(FEATURES, 1e-6, np.float32), np.full((FEATURES, RANK), 1e-6, np.float32)
    n, good = len(rows), float(labels.sum())
    if not n:
        return Machine(0.0, w, v * 0)
    weight = np.where(labels == 1, n / (2 * max(good, 1)), n / (2 * max(n - good, 1)))
    for _ in range(EPOCHS):
        order = dice.permutation(n)
        for k in range(0, n, BATCH):
            part = order[k:k + BATCH]
            at, x = np.concatenate([rows[i][0] for i in part]), np.concatenate([rows[i][1] for i in part])
            sizes = np.array([len(rows[i][0]) for i in part])
            start, row = np.r_[0, np.cumsum(sizes)[:-1]], np.repeat(np.arange(len(part)), sizes)
            vx = v[at] * x[:, None]
            total = np.add.reduceat(vx, start)
            z = w0 + np.add.reduceat(w[at] * x, start) + 0.5 * (total * total - np.add.reduceat(vx * vx, start)).sum(1)
            g = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[part]) * weight[part] / len(part)).astype(np.float32)
            slots, back = np.unique(at, return_inverse=True)
            dw = np.bincount(back, g[row] * x, len(slots)).astype(np.float32) + DECAY * w[slots]
            dv = np.zeros((len(slots), RANK), np.float32)
            np.add.at(dv, back, (g[row] * x)[:, None] * (total[row] - vx))
            dv += DECAY * v[slots]
            gw[slots] += dw * dw
            gv[slots] += dv * dv
            w[slots] -= RATE * dw / np.sqrt(gw[slots])
            v[slots] -= 0.3 * RATE * dv / np.sqrt(gv[slots])
            d0 = float(g.sum())
            g0 += d0 * d0
            w0 -= RATE * d0 / g0 ** 0.5
    return Machine(w0, w, v)


def fold(doc_id: Column) -> Column:
    """Remainder by 3 of the id's CRC: 1 is held out."""
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(3)).cast("int")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Machine:
    """Fit on the labelled documents that are not held out, at most ``rows`` of them by least hash.

    Of the rows that share an id the one with the least text hash counts.  One task fits: its input is those
    rows' features.  Null labels are left out."""
    spark = docs.sparkSession
    chosen = (labels.where(labels["quality"].isNotNull() & labels["doc_id"].isNotNull() & ~held_out(labels["doc_id"]))
              .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("quality").alias("label"))
              .withColumn("rank", F.xxhash64("id")).orderBy("rank", "id").limit(rows))
    given = _input(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("rank", "label", "text", "n_chars")
    least = F.min_by(F.struct("text", "n_chars"), F.struct(F.xxhash64("text"), "n_chars"))
    given = given.groupBy("rank", "label").agg(least.alias("row")).select("rank", "label", "row.*")

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = [features(t, n) for t, n in zip(b.column("text").to_pylist(), b.column("n_chars").to_pylist())]
            yield pa.RecordBatch.from_pydict({
                "rank": b.column("rank"), "label": b.column("label").cast(pa.int32()),
                "at": pa.array([x.tobytes() for x, _ in f], pa.binary()), "x": pa.array([x.tobytes() for _, x in f], pa.binary())})

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted((r, a, x, y) for b in batches for r, a, x, y in zip(*(b.column(c).to_pylist() for c in ("rank", "at", "x", "label"))))
        m = fit([(np.frombuffer(a, np.int32), np.frombuffer(x, np.float32)) for _, a, x, _ in found], np.array([y for *_, y in found], np.float32))
        yield pa.RecordBatch.from_pydict({"w0": [float(m.w0)], "w": [m.w.tobytes()], "v": [m.v.tobytes()]})

    model = given.mapInArrow(described, "rank long, label int, at binary, x binary").repartition(1).mapInArrow(
        fitted, "w0 double, w binary, v binary").collect()
    if not model:
        return fit([], np.zeros(0, np.float32))
    return Machine(model[0]["w0"], np.frombuffer(model[0]["w"], np.float32), np.frombuffer(model[0]["v"], np.float32).reshape(FEATURES, RANK))


def _input(docs: DataFrame) -> DataFrame:
    length = docs["n_chars"].cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"), length.alias("n_chars"))


def score(docs: DataFrame, model: Machine) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.  Null text: empty; its score comes from
    the statistics.  Equal inputs have equal scores.  A null id is not held out.  An empty table
    gives no rows, and without any label all scores are 0.5."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [model.score(*features(t, n)) for t, n in zip(b.column("text").to_pylist(), b.column("n_chars").to_pylist())]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "score": pa.array(s, pa.float64())})
    scored = _input(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
