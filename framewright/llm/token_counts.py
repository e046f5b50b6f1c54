"""Token counts: two-tier lookup of pre-token lengths inside the map tasks.

Tier one is a compact table of the most frequent pre-tokens with their lengths in tokens, sent to
every worker.  Tier two is a cache in each worker that encodes a missing pre-token once.  Only the
text scan runs; no pre-token is ever shuffled.  The frequent table is taken from a hash-chosen set of
about ``FREQUENT_DOCS`` documents; it only saves time, every text is counted whole whatever it holds.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.bpe import PreTokens, Table
from framewright.llm.common import texts

#: Documents read for the frequent table, its entries, its longest pre-token, entries of a worker's cache.
FREQUENT_DOCS, FREQUENT_ENTRIES, FREQUENT_CHARS, CACHE_ENTRIES = 2_000, 32_768, 32, 600_000

_WORKER: dict = {}


def _pre_tokens(path: str) -> PreTokens:
    if path not in _WORKER:
        _WORKER[path] = PreTokens(path)
    return _WORKER[path]


def frequent_lengths(docs: DataFrame, path: str, n_docs: int = FREQUENT_DOCS,
                     entries: int = FREQUENT_ENTRIES) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of about ``n_docs`` documents chosen by hash.

    The hash is of id and text, so rows that share an id are not chosen together.  Each task counts its own
    and gives a bounded list; the lists are summed by pre-token, and ``entries`` of them stay."""
    total = docs.count()
    share = min(1.0, n_docs / max(total, 1))
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre, seen = _pre_tokens(path), Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                for run in pre.runs(text) or ():
                    seen.update(run)
            if len(seen) > 8 * entries:
                seen = Counter(dict(seen.most_common(4 * entries)))
        top = [(t, k) for t, k in seen.most_common(4 * entries) if t not in pre.special and len(t) <= FREQUENT_CHARS]
        yield pa.RecordBatch.from_pydict({"token": pa.array([t for t, _ in top], pa.string()), "k": pa.array([k for _, k in top], pa.int64())})

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre = _pre_tokens(path)
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"token": batch.column("token"), "n": pa.array(
                [len(pre.token_ids(t)) for t in batch.column("token").to_pylist()], pa.int32())})

    counts = chosen.select("text").mapInArrow(count, "token string, k long").groupBy("token").agg(F.sum("k").alias("k"))
    top = counts.orderBy(F.desc("k"), "token").limit(entries).select("token")
    return {r["token"]: r["n"] for r in top.mapInArrow(measured, "token string, n int").collect()}


def count_tokens(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``.

    Null text: no bytes, no tokens.  Special strings inside a text count as the library's default
    does.  Repeated rows give a row each; an empty table gives no rows."""
    rows = texts(docs)
    frequent = frequent_lengths(rows, path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre = _pre_tokens(path)
        table = _WORKER.get(("lengths", path))
        if table is None or table.given.keys() != frequent.keys():
            table = _WORKER["lengths", path] = Table(frequent, lambda t: len(pre.token_ids(t)), CACHE_ENTRIES)
        look = table.__getitem__
        for batch in batches:
            n = []
            for text in batch.column("text").to_pylist():
                runs = pre.runs(text)
                n.append(len(pre.whole_ids(text)) if runs is None else sum(sum(map(look, run)) for run in runs))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"), "n_tokens": pa.array(n, pa.int64())})

    counted = rows.withColumn("n_bytes", F.octet_length("text").cast("long")).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    return public_tokenizers.path(name)


def spec_of(path: str) -> dict:
    """The tokenizer file as a dictionary (for tests and reports)."""
    with open(path, encoding="utf-8") as f:
        return json.load(f)
