"""The corpus pipeline: each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from fragmill.llm import bpe, linededup, mixing, neardup, quality
from fragmill.llm.common import cut, table

VOCABULARY = "byte_bpe_50k.tiktoken"
#: The share of the tokens that the mixture keeps.
FRACTION = 0.8


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (6)."""
    model = quality.learned(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, *model).where("predicted = 1").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of later repeats of runs of 50 words or more (10); n_chars follows."""
    rows = linededup.line_dedup(docs)
    return rows.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is alike in 0.8 of its five-word shingles (1)."""
    return neardup.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to tempered shares of source, language and topic (9)."""
    return mixing.mixed(docs, FRACTION).where("_picked").select(docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, tokens, decoded_sha256): byte-level BPE of every text, and a hash of what it decodes to (4).

    tokens are unsigned 32-bit little-endian integers, one after another.
    """
    rows = bpe.round_trip(docs, bpe.read_ranks(public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN)
    return rows.select(
        "doc_id",
        (F.length("packed") / 4).cast("long").alias("n_tokens"),
        F.col("packed").alias("tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", quality_filter),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mix),
    ("bpe", tokenize),
]

#: Learned scores and merges have no SQL; the stages are held against brute force in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
