"""Queries of the subpackage: one thin query per operator, and the SQL of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm import (chosen_path, fingerprints, hard_negatives, mixing, packing, prefix_trie, quality_classifier, quality_rules, resharding,
                             seed_extend, sequence_files, suffix_dedup, token_counts)
from framewright.llm.common import documents
from framewright.session import shared_dir
from framewright.sources.tables import load

Builder = Callable[[SparkSession, str], DataFrame]


#: The layout that op6 starts from: shards by source, so the largest source overfills one of them.
OLD_SHARDS, NEW_SHARDS = 16, 24


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "source", "size", "source_size", "target", "taken", "copies")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(documents(spark, sf_dir))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), token_counts.tokenizer_path())


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf_dir))


def op5_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_classifier.score(docs, quality_classifier.train(docs, load(spark, sf_dir, "labels")))


def op6_flow_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    old = F.pmod(F.crc32(F.encode(F.coalesce(docs["source"], F.lit("")), "UTF-8")), F.lit(OLD_SHARDS))
    placed = resharding.resharded(docs, old, OLD_SHARDS, [1] * NEW_SHARDS, shared_dir(spark, "reshard-shards"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op7_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.digest(documents(spark, sf_dir))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removals(documents(spark, sf_dir))


def op9_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed_extend.removals(documents(spark, sf_dir))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), token_counts.tokenizer_path())


def op11_sequence_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence_files.token_files(documents(spark, sf_dir), token_counts.tokenizer_path())


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mined_embeddings(load(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(load(spark, sf_dir, "conversations"))


def queries() -> dict[str, Builder]:
    return {f.__name__: f for f in (op1_source_mix, op2_quality_rules, op3_token_counts, op4_fingerprints,
                                  op5_factorisation_machine, op6_flow_resharding, op7_chosen_path, op8_suffix_dedup, op9_seed_extend,
                                  op10_best_fit_packing, op11_sequence_files, op12_hard_negatives, op13_prefix_trie)}


def oracle_sql() -> dict[str, str]:
    return {"op1_source_mix": mixing.SQL, "op12_hard_negatives": hard_negatives.SQL}
