"""Corpus pipeline: five stages over ``documents``, each written as Parquet and reread by the next one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.blocks import bounded_batches, hand_off, table, unused
from shelfwise.llm.byte_bpe import bpe_round_trip, id_digests
from shelfwise.llm.decontam import drop_leaks
from shelfwise.llm.ngram_join import ngram_jaccard_join
from shelfwise.llm.quality import keep_good
from shelfwise.llm.suffix_dedup import strip_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their group's thresholds."""
    bounded_batches(spark)
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the document with the least id.

    Documents without an id can't be compared and stay.
    """
    bounded_batches(spark)
    joined = ngram_jaccard_join(docs, width=5, percent=80)
    (name,) = unused(docs.columns, "_gone")
    gone = hand_off(joined.where("doc_id <> component_id").select(F.col("doc_id").alias(name)).distinct(), "gone")
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 100-byte strings that start earlier in the corpus; ``n_chars`` follows.

    Documents without an id have no place in the order and stay as they are.
    """
    stripped = strip_repeats(docs)
    return stripped.unionByName(docs.where("doc_id is null")).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of each text, and digests of the ids and of what they decode to."""
    bounded_batches(spark)
    encoded = bpe_round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep=("doc_id",))
    return id_digests(encoded)


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("benchmark_decontamination", decontaminate),
    ("byte_bpe", tokenize),
]

# The byte-level encoding can't be expressed in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each handed to the next as a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = hand_off(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
