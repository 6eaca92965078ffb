"""The registered queries of the corpus operators and the SQL that states their results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import (
    importance, line_dedup, mixing, neighbours, packing, prefix_trie, quality_rules, sharding, simhash, substring_dedup,
    target_resampling, token_counts, warc)
from panelcast.llm.common import table


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"), carry=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_and_read(table(spark, folder, "pages")).drop("url", "payload")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"), carry=["doc_id"])
    return counted.select("row.doc_id", "n_bytes", "n_tokens", "over_limit")


def op4_importance(spark: SparkSession, folder: str) -> DataFrame:
    drawn = importance.resample(table(spark, folder, "documents"), table(spark, folder, "labels"), carry=["doc_id"])
    return drawn.select("row.doc_id", "n_words", "log_weight", "key", "kept")


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), carry=["doc_id"])
    return found.select("row.doc_id", F.lower(F.hex("print")).alias("fingerprint"), F.col("component").alias("component_id"))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, folder, "documents"), carry=["doc_id"])
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_shard(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard(table(spark, folder, "documents"), carry=["doc_id"])
    return placed.select("row.doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op8_pack(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"), carry=["doc_id"])
    return packed.select("row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op9_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.apply_rules(table(spark, folder, "documents"), table(spark, folder, "labels"), carry=["doc_id"])
    return judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = prefix_trie.rebuilt(table(spark, folder, "conversations"))
    return prefix_trie.prefix_trie(turns)


def op12_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.dedup_substrings(table(spark, folder, "documents"), width=50, carry=["doc_id"])
    return kept.select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_target_resampling(spark: SparkSession, folder: str) -> DataFrame:
    drawn = target_resampling.resample_to_target(table(spark, folder, "documents"), table(spark, folder, "benchmark"),
                                                 longest=1, buckets=10_000, percent=10, least_words=20, seed=2024, carry=["doc_id"])
    return drawn.select("row.doc_id", "n_features", "weight", "score", "rank")


QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_warc, op3_token_counts, op4_importance, op5_simhash, op6_line_dedup,
                                  op7_shard, op8_pack, op9_neighbours, op10_quality_rules, op11_prefix_trie,
                                  op12_substring_dedup, op13_target_resampling)}
ORACLES = {"op1_mix_sources": mixing.SQL, "op2_warc": warc.SQL, "op6_line_dedup": line_dedup.SQL,
           "op11_prefix_trie": prefix_trie.SQL, "op12_substring_dedup": substring_dedup.SQL,
           "op13_target_resampling": target_resampling.SQL}
