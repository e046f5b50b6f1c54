"""Suffix-array dedup: bytes that an earlier document has in a run of ``WINDOW`` or more.

The blocks of repeated anchors that meet in a task are laid into one text and its suffix array is built
in two stages: only suffixes smaller than their successors are sorted directly; the others are
induced by scanning the buckets of first bytes in order.  Suffixes are needed in the order of their
first ``DEPTH`` bytes, and only those of windows and what induces them.  Adjacent suffixes with a common
prefix of at least ``WINDOW`` bytes hold the same window; the least id among them decides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.anchors import BYTE_UNITS
from framewright.llm.repeats import spans, with_spans

WINDOW, GRAM, DEPTH = 50, 16, 56


def byte_units(text: str):
    raw = text.encode("utf-8", "surrogatepass")
    return BYTE_UNITS[np.frombuffer(raw, np.uint8)], lambda a, z: raw[a:z]


def _eight(text: np.ndarray) -> np.ndarray:
    """At each place the next eight bytes as one big-endian number; the text ends in zeros."""
    wide = text.astype(np.uint64)
    out = np.zeros(len(text), np.uint64)
    for k in range(8):
        out[:len(text) - k] |= wide[k:] << np.uint64(56 - 8 * k)
    return out


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one that starts a byte later."""
    step = np.zeros(len(text), np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    step[-1] = 1                                    # the end itself is the smallest suffix
    place = np.where(step != 0, np.arange(len(text)), len(text) - 1)
    following = np.minimum.accumulate(place[::-1])[::-1]      # a run of equal bytes goes by its end
    return step[following] > 0


def _direct(starts: np.ndarray, eight: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` sorted by ``depth`` bytes: eight at a time, and only where still tied."""
    order = starts[np.argsort(eight[starts], kind="stable")]
    if len(order) < 2:
        return order
    word = eight[order]
    group = np.r_[0, np.cumsum(word[1:] != word[:-1])]
    for k in range(8, depth, 8):
        tied = np.zeros(len(order), bool)
        same = group[1:] == group[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        at = np.flatnonzero(tied)
        if not len(at):
            break
        part, g = order[at], group[at]
        word = eight[np.minimum(part + k, len(eight) - 1)]
        by = np.lexsort((word, g))
        order[at], word, g = part[by], word[by], g[by]
        new = np.zeros(len(order), bool)
        new[1:] = group[1:] != group[:-1]
        new[at[1:]] |= (word[1:] != word[:-1]) & (g[1:] == g[:-1])
        group = np.cumsum(new)
    return order


def suffix_order(text: np.ndarray, wanted: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """The wanted suffixes in the order of their first ``depth`` bytes.  ``text`` ends in a zero byte
    that is smaller than the rest; ``wanted`` marks suffixes."""
    small = smaller_than_next(text)
    need = wanted.copy()
    front = np.flatnonzero(need & ~small)
    while len(front):                               # an induced suffix needs its successor
        front = front[front + 1 < len(text)] + 1
        front = front[~need[front]]
        need[front] = True
        front = front[~small[front]]
    eight = _eight(text)
    direct = _direct(np.flatnonzero(need & small), eight, depth)
    first = text[direct]
    induced = need & ~small
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out: list[np.ndarray] = []

    def hand_on(places: np.ndarray, byte: int) -> np.ndarray:
        """Send predecessors to the buckets of their bytes; those of this bucket come back."""
        before = places[places > 0] - 1
        before = before[induced[before]]
        own = text[before]
        later = before[own > byte]
        if len(later):
            own_later = text[later]
            by = np.argsort(own_later, kind="stable")
            later, own_later = later[by], own_later[by]
            cut = np.flatnonzero(np.r_[True, own_later[1:] != own_later[:-1]])
            for a, z in zip(cut, np.r_[cut[1:], len(later)]):
                waiting[own_later[a]].append(later[a:z])
        return before[own == byte]

    bounds = np.searchsorted(first, np.arange(257))
    for byte in range(256):
        layer = np.concatenate(waiting[byte]) if waiting[byte] else np.zeros(0, np.int64)
        while len(layer):
            out.append(layer)
            layer = hand_on(layer, byte)
        sorted_part = direct[bounds[byte]:bounds[byte + 1]]
        if len(sorted_part):
            out.append(sorted_part)
            hand_on(sorted_part, byte)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    return order[wanted[order]]


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int = WINDOW) -> np.ndarray:
    """Bytes that each suffix of the order shares with the one before it, at most ``most``."""
    out = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    for k in range(most):
        a, b = order[live] + k, order[live - 1] + k
        same = text[np.minimum(a, len(text) - 1)] == text[np.minimum(b, len(text) - 1)]
        live = live[same & (a < len(text)) & (b < len(text))]
        out[live] = k + 1
        if not len(live):
            break
    return out


def window_thresholds(_h, blocks: list[bytes], count: np.ndarray, _off, key: np.ndarray) -> np.ndarray:
    """For each block and window the least id of a block with that window."""
    size = np.array([len(b) for b in blocks])
    begin = np.r_[0, np.cumsum(size)[:-1]]
    text = np.frombuffer(b"".join(blocks) + bytes(DEPTH + 8), np.uint8)
    owner = np.repeat(np.arange(len(blocks)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    place = begin[owner] + nth
    wanted = np.zeros(len(text), bool)
    wanted[place] = True
    slot = np.zeros(len(text), np.int64)
    slot[place] = np.arange(len(place))
    order = suffix_order(text, wanted)
    new = common_prefixes(text, order) < WINDOW
    start = np.flatnonzero(new)
    at = slot[order]
    least = np.minimum.reduceat(key[owner[at]], start)
    each = np.empty(len(place), np.int64)
    each[at] = np.repeat(least, np.diff(np.r_[start, len(order)]))
    out = np.full((len(blocks), int(count.max())), np.iinfo(np.int64).max)
    out[owner, nth] = each
    return out


def _pieces(raw: bytes, whole_copy: bool, found: bytes | None) -> tuple[bytes, int, int]:
    """What stays of a text, bytes removed, number of removed runs."""
    if whole_copy and len(raw) >= WINDOW:
        return b"", len(raw), 1
    if not found:
        return raw, 0, 0
    runs = np.frombuffer(found, "<i8").reshape(-1, 2).tolist()
    kept, at, removed = [], 0, 0
    for a, z in runs:
        kept.append(raw[at:a])
        removed += z - a
        at = z
    kept.append(raw[at:])
    return b"".join(kept), removed, len(runs)


def removals(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document.

    Null text: empty.  Texts under 50 bytes lose nothing.  Repeated rows with one id do not remove each
    other's bytes.  An empty table gives no rows."""
    some = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    rows = with_spans(some, *spans(some, byte_units, WINDOW, GRAM, window_thresholds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, found, copy in zip(*(b.column(c).to_pylist() for c in ("text", "__spans", "__copy"))):
                raw = text.encode("utf-8", "surrogatepass")
                kept, removed, n = _pieces(raw, bool(copy), found)
                out.append((len(raw), removed, n, hashlib.sha256(kept).hexdigest()))
            n, removed, runs, sha = zip(*out) if out else [()] * 4
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "n_bytes": pa.array(n, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                                              "n_spans": pa.array(runs, pa.int64()), "kept_sha256": pa.array(sha, pa.string())})
    return rows.withColumn("text", F.coalesce("text", F.lit(""))).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with the repeated bytes taken out of their texts; a column ``n_chars`` follows,
    the others are unchanged.

    What a border leaves of a character goes too.  Documents that lose everything go; those that were
    empty or null stay as they are."""
    names = docs.columns
    rows = with_spans(docs, *spans(docs, byte_units, WINDOW, GRAM, window_thresholds))
    others = F.struct(*[F.col(c) for c in names if c != "text"]) if len(names) > 1 else F.struct(F.lit(0).alias("none"))
    rows = rows.select(others.alias("row"), "text", "__spans", "__copy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, found, copy in zip(*(b.column(c).to_pylist() for c in ("text", "__spans", "__copy"))):
                if text is None or not found and not copy:
                    out.append((text, False, False))
                else:
                    raw = text.encode("utf-8", "surrogatepass")
                    kept, removed, _ = _pieces(raw, bool(copy), found)
                    out.append((kept.decode("utf-8", "ignore") if removed else text, bool(removed), bool(removed) and not kept.strip()))
            texts, changed, gone = zip(*out) if out else [()] * 3
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(texts, pa.string()), pa.array(changed, pa.bool_()), pa.array(gone, pa.bool_())],
                                             names=["row", "text", "changed", "gone"])
    schema = rows.select("row", "text", F.lit(False).alias("changed"), F.lit(False).alias("gone")).schema
    left = rows.mapInArrow(run, schema).where("not gone")
    def column(c: str):
        if c == "text":
            return F.col("text")
        if c == "n_chars":
            return F.when(F.col("changed"), F.char_length("text")).otherwise(F.col("row.n_chars")).cast(docs.schema[c].dataType).alias(c)
        return F.col("row")[c].alias(c)
    return left.select(*[column(c) for c in names])
