"""Document fingerprints: one-permutation MinHash, optimal densification, packed low-order bits.

Every five-word shingle of a text (its whole word sequence if shorter) is hashed once.  The high bits
choose one of ``BINS`` bins, which keeps its least hash.  An empty bin takes the value of the first
full bin on its own fixed random walk over the bins.  Of each bin's value, hashed with the bin, the
``LOW`` lowest bits are kept, so two fingerprints agree in a bin by chance with probability
``2 ** -LOW``; the likeness takes that out.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.llm.bpe import Table
from framewright.llm.common import WORDS, stored, texts

BINS, LOW, SHINGLE = 512, 4, 5
_TOP = 64 - (BINS - 1).bit_length()
_WORD_HASHES = Table({}, lambda w: xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")), 500_000)
_MULTIPLIERS = np.random.default_rng(5).integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WALKS: list[np.ndarray] = []


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over the whole range (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_WORD_HASHES.__getitem__, words), np.uint64, len(words))


def shingle_hashes(w: np.ndarray, length: int = SHINGLE) -> np.ndarray:
    """Hash of each run of ``length`` words; fewer words are one run."""
    n = len(w)
    if not n:
        return w
    with np.errstate(over="ignore"):
        if n < length:
            return _mixed(np.array([(w * _MULTIPLIERS[:n]).sum() + np.uint64(n)], np.uint64))
        out = np.zeros(n - length + 1, np.uint64)
        for k in range(length):
            out += w[k:n - length + 1 + k] * _MULTIPLIERS[k]
        return _mixed(out)


def _walk(step: int) -> np.ndarray:
    """The bin that each bin looks at in this step of its walk."""
    while len(_WALKS) <= step:
        k = np.arange(BINS, dtype=np.uint64) + np.uint64(BINS * (len(_WALKS) + 1))
        with np.errstate(over="ignore"):
            _WALKS.append((_mixed(k * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(BINS)).astype(np.int64))
    return _WALKS[step]


def sketch(shingles: np.ndarray) -> np.ndarray | None:
    """Low bits of the bins; None without shingles."""
    if not len(shingles):
        return None
    s = np.sort(shingles)
    bins = (s >> np.uint64(_TOP)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
    least, full = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    least[bins[first]], full[bins[first]] = s[first], True
    empty, step = np.flatnonzero(~full), 0
    if len(first) == 1:
        least[:] = s[0]
        empty = empty[:0]
    while len(empty):
        seen = _walk(step)[empty]
        hit = full[seen]
        least[empty[hit]] = least[seen[hit]]
        empty, step = empty[~hit], step + 1
    # Hashed once more with the bin, so that bins filled from one shingle agree by chance one by one.
    with np.errstate(over="ignore"):
        own = _mixed(least ^ (np.arange(BINS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return (own & np.uint64((1 << LOW) - 1)).astype(np.uint8)


def packed(bits: np.ndarray | None) -> str:
    """The fingerprint as text: the low bits packed and in base 64; empty without shingles."""
    if bits is None:
        return ""
    each = np.unpackbits(bits[:, None], axis=1)[:, 8 - LOW:]
    return base64.b64encode(np.packbits(each.ravel()).tobytes()).decode()


def unpacked(fingerprint: str) -> np.ndarray | None:
    if not fingerprint:
        return None
    each = np.unpackbits(np.frombuffer(base64.b64decode(fingerprint), np.uint8)).reshape(BINS, LOW)
    return np.packbits(each, axis=1)[:, 0] >> (8 - LOW)


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """Estimated share of common shingles; two texts without words are alike."""
    if a is None or b is None:
        return float(a is None and b is None)
    chance = 2.0 ** -LOW
    return float(min(1.0, max(0.0, ((a == b).mean() - chance) / (1 - chance))))


def fingerprint(text: str) -> np.ndarray | None:
    return sketch(shingle_hashes(word_hashes(WORDS.findall(text))))


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_FIELDS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
_NAMES = [f.split()[0] for f in re.split(", ", _FIELDS)]


def _described(doc_id, text: str, own, following: str, other) -> tuple:
    edited = _edited(text, following)
    edit = fingerprint(edited)
    return (doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), packed(own), packed(edit),
            likeness(own, edit), likeness(own, other))


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document, with its fingerprint, that of its edited text and both likenesses.

    The next document has the next smaller id (null last, then by a hash of the text); after the last comes
    the first.  Texts are dealt once by ranges of (id, text hash, row number), so that rows that share an id, or
    have none, are split, and equal rows as well.  Each task streams its range in order; the last
    document of a range meets the first of the next range afterwards, one pair per range.  Null text:
    empty.  A lone document is its own next.  An empty table gives no rows."""
    spark = docs.sparkSession
    order = [F.col("doc_id").desc_nulls_last(), "h", "nth"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The driver samples the keys of the ranges; texts are no part of them.  Rows that tie in id and hash are
    # equal, so a row number that comes out otherwise after a lost task changes no result.
    rows = texts(docs).withColumn("h", F.xxhash64("text")).withColumn("nth", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    extra, types = ["part", "kind", "text"], [*_TYPES, pa.int32(), pa.int32(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), None
        for batch in batches:
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                own = fingerprint(text)
                if before is None:
                    out.append((doc, None, None, packed(own), None, None, None, part, 2, text))
                else:
                    out.append((*_described(*before, text, own), part, 0, None))
                before = (doc, text, own)
            yield _batch(out, [*_NAMES, *extra], types)
        if before is not None:
            yield _batch([(before[0], None, None, packed(before[2]), None, None, None, part, 1, before[1])], [*_NAMES, *extra], types)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "fingerprint", "next_text", "next_fingerprint")))
            yield _batch([_described(d, t, unpacked(f), nt, unpacked(nf)) for d, t, f, nt, nf in rows], _NAMES, _TYPES)

    found = stored(ordered.mapInArrow(run, f"{_FIELDS}, part int, kind int, text string"), "fingerprints", "zstd")
    heads = found.where("kind = 2")
    by = Window.orderBy("part")                     # one row per range
    after = heads.select("part", F.coalesce(F.lead("part").over(by), F.min("part").over(Window.partitionBy())).alias("next_part"))
    first = heads.select(F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint"))
    open_ = found.where("kind = 1").select("part", "doc_id", "text", "fingerprint").join(after, "part").join(first, "next_part")
    closed = open_.select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint").mapInArrow(close, _FIELDS)
    return found.where("kind = 0").select(*_NAMES).unionByName(closed)
