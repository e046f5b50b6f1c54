"""Substring dedup by seed and extend: words that an earlier document has in a run of 50 or more.

Documents meet on winnowed anchors of ``GRAM`` words, the seeds.  Where two blocks of a seed differ, the
match is extended word by word to the left and to the right, and kept as a maximal repeat if it
reaches ``WINDOW`` words.  Blocks that are the same word for word are one.  A seed with more than
``PAIRS_OF`` different blocks is too common to pair them: there the seed is lengthened to whole windows,
which is an exact search as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import WORDS
from framewright.llm.fingerprints import word_hashes
from framewright.llm.repeats import spans, with_spans

WINDOW, GRAM, PAIRS_OF, PAIRS_AT_ONCE = 50, 10, 128, 20_000
REACH = WINDOW - GRAM


def word_units(text: str):
    words = WORDS.findall(text)
    return word_hashes(words), lambda a, z: " ".join(words[a:z]).encode("utf-8", "surrogatepass")


def _matched(same: np.ndarray) -> np.ndarray:
    """Length of the run of matches from the seed on."""
    return np.cumprod(same, axis=1, dtype=np.int8).sum(1, dtype=np.int64)


def window_thresholds(h: np.ndarray, blocks: list[bytes], count: np.ndarray, off: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For each block and window the least id of a block of the same seed with that window."""
    n = len(blocks)
    least = np.repeat(key[:, None], int(count.max()), 1)
    new = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    size = np.diff(np.r_[new, n])
    several = size > 1
    if not several.any():
        return least
    some = np.flatnonzero(np.repeat(several, size))
    row = np.full(n, -1)
    row[some] = np.arange(len(some))
    left, right = np.zeros((len(some), REACH), np.uint64), np.zeros((len(some), REACH), np.uint64)
    units = {}
    for i, k in enumerate(some):                    # contexts of the seed, nearest word first
        w = word_hashes(blocks[k].decode("utf-8", "surrogatepass").split(" "))
        o = off[k]
        left[i, :o] = w[:o][::-1]
        tail = w[o + GRAM:o + GRAM + REACH]
        right[i, :len(tail)] = tail
        left[i, o:], right[i, len(tail):] = 2 * i + 1, 2 * i + 2          # past the end nothing matches
        units[k] = w
    pairs_a, pairs_b, held = [], [], 0

    def extend() -> None:
        nonlocal pairs_a, pairs_b, held
        a, b = np.concatenate(pairs_a), np.concatenate(pairs_b)
        pairs_a, pairs_b, held = [], [], 0
        to_left, to_right = _matched(left[row[a]] == left[row[b]]), _matched(right[row[a]] == right[row[b]])
        keep = to_left + GRAM + to_right >= WINDOW
        a, b, to_left, to_right = a[keep], b[keep], to_left[keep], to_right[keep]
        if not len(a):
            return
        j = np.arange(least.shape[1])
        for x, y in ((a, b), (b, a)):
            back = off[x][:, None] - j              # words from the window's start to the seed
            inside = (j < count[x][:, None]) & (back <= to_left[:, None]) & (WINDOW - GRAM - back <= to_right[:, None])
            r, c = np.nonzero(inside)
            np.minimum.at(least, (x[r], c), key[y[r]])

    for a, z in zip(new[several], (new + size)[several]):
        m = z - a
        if m > PAIRS_OF:
            _whole_windows(range(a, z), units, count, off, key, least)
            continue
        i, j = np.triu_indices(m, 1)
        pairs_a.append(a + i)
        pairs_b.append(a + j)
        held += len(i)
        if held >= PAIRS_AT_ONCE:
            extend()
    if held:
        extend()
    return least


def _whole_windows(members, units, count, off, key, least) -> None:
    """Seeds as long as the window: equal windows of one seed have equal word hashes throughout."""
    seen: dict = {}
    for k in members:
        raw = units[k].tobytes()
        for j in range(count[k]):
            w = raw[8 * j:8 * (j + WINDOW)]
            seen[w] = min(seen.get(w, key[k]), key[k])
    for k in members:
        raw = units[k].tobytes()
        for j in range(count[k]):
            least[k, j] = seen[raw[8 * j:8 * (j + WINDOW)]]


def removals(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every document.

    Null text: no words.  Texts under 50 words lose nothing.  Repeated rows with one id do not remove
    each other's words.  An empty table gives no rows."""
    some = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    rows = with_spans(some, *spans(some, word_units, WINDOW, GRAM, window_thresholds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, found, copy in zip(*(b.column(c).to_pylist() for c in ("text", "__spans", "__copy"))):
                words = WORDS.findall(text)
                n = len(words)
                if copy and n >= WINDOW:
                    kept = []
                elif found:
                    kept, at = [], 0
                    for a, z in np.frombuffer(found, "<i8").reshape(-1, 2).tolist():
                        kept += words[at:a]
                        at = z
                    kept += words[at:]
                else:
                    kept = words
                out.append((n, n - len(kept), hashlib.sha256(" ".join(kept).encode("utf-8", "surrogatepass")).hexdigest()))
            n, removed, sha = zip(*out) if out else [()] * 3
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "n_words": pa.array(n, pa.int64()),
                                              "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(sha, pa.string())})
    return rows.withColumn("text", F.coalesce("text", F.lit(""))).mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string")
