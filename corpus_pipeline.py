"""Corpus pipeline: from ``documents`` to packed training sequences in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it kept.  The first
four return the columns of ``documents``; the last returns the pieces and their sequences.

1. quality rules: documents that the rules reject go;
2. near-dedup: one document of each group of near copies stays;
3. suffix-array dedup: bytes that an earlier document has in a run of 50 or more go;
4. source mix: each source's documents are taken as often as its target asks for, 0 to 2 times;
5. best-fit packing into sequences of 1024 tokens.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from framewright.llm import chosen_path, mixing, packing, quality_rules, suffix_dedup, token_counts
from framewright.llm.common import discard, documents, release, stored, stored_count, stored_since

_LEFT: list[str] = []


def _stage(work):
    """A stage that first deletes the tables that the stages before it stored.

    ``docs`` is what the stage before wrote, read again, so its own tables have been used by then; tables that
    ``docs`` reads all the same are kept."""
    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _LEFT[:] = release(_LEFT, docs)
        mark = stored_count()
        out = work(spark, docs, sf_dir)
        _LEFT.extend(stored_since(mark))
        return out
    return run_stage


@_stage
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept_documents(docs)


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chosen_path.deduplicated(docs)


@_stage
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


@_stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, token_counts.tokenizer_path())


STAGES = [
    ("quality rules", keep_quality),
    ("near-dedup", drop_near_duplicates),
    ("suffix-array dedup", cut_repeats),
    ("source mix", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: SQL cannot state the covariance estimate, the components or the packing; tests/llm compare the
#: stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read by the next one."""
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
        if before is not None:
            discard(before)
        before = docs
    return docs
