"""From raw documents to packed training sequences: five stages, each over all that the one before kept.

A stage takes and returns documents; its result is written to the shared folder
and read again by the next.  The last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import line_dedup, mixing, packing, quality_rules, simhash
from panelcast.llm.common import table
from panelcast.llm.queries import tokenizer_path
from panelcast.session import materialize


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs."""
    return quality_rules.apply_rules(docs, table(spark, sf_dir, "labels")).filter("kept").select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents hold stay in the one with the smallest id; lengths follow the texts."""
    cut = line_dedup.dedup_lines(docs)
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return cut.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles are linked at two bits or fewer."""
    return simhash.drop_near_duplicates(docs, width=3, radius=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target has them."""
    return mixing.mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 4096 tokens."""
    packed = packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), carry=["doc_id", "source", "lang"])
    return packed.select("row.*", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("quality_rules", keep_quality), ("line_dedup", drop_repeated_lines), ("simhash_near_dedup", drop_near_duplicates),
          ("mix_sources", mix_sources), ("best_fit_packing", pack_sequences)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
