"""The queries opN_<name> over the given tables, and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, langid, quality
from .common import scratch_dir, table
from .exact_dedup import exact_duplicates
from .linededup import line_dedup
from .mixing import mixed
from .pii import pseudonymised
from .shards import ShardStore, sharded
from .simhash import simhash_groups
from .spelling import spelling_variants
from .vectors import near_vectors
from .winnowing import digest, edited_fingerprints

VOCABULARY = "byte_bpe_50k.tiktoken"
ALIGNED = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Only for the query over the given tables; users pass a key of their own.
KEY = "given tables"


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word SimHashes differ in three bits at most."""
    return simhash_groups(table(spark, sf_dir, "documents"), words=3).drop("fp")


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowed fingerprints of every text and of its edited text, and how alike they are."""
    rows = edited_fingerprints(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        digest(F.col("kept")).alias("fingerprint"),
        digest(F.col("edited_kept")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as the last version of a store has them, after eight arrivals and the compactions between them; texts as hashes."""
    docs = table(spark, sf_dir, "documents")
    rows = sharded(docs, ShardStore(spark, scratch_dir(spark), docs.schema), arrivals=8)
    return rows.select("doc_id", "lang", "source", "n_chars", F.sha2("text", 256).alias("text_sha256"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text and what they decode to, as counts and hashes."""
    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    rows = bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return rows.select(
        "doc_id",
        (F.length("packed") / 4).cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms for private numbers, dates and addresses, and what kinds were found."""
    rows = pseudonymised(table(spark, sf_dir, "documents"), KEY)
    return rows.select(
        "doc_id",
        "text",
        F.size("found").cast("long").alias("n_found"),
        F.array_join(F.transform("found", lambda f: f["kind"]), ",").alias("kinds"),
    )


def _fold(modulus: int, held: int):
    return (F.crc32(F.col("doc_id").cast("string")) % modulus == held).alias("held_out")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every text, learned from the labels of four folds in five."""
    docs = table(spark, sf_dir, "documents")
    model = quality.learned(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, *model).select("doc_id", _fold(5, 0), "score", "predicted")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learned from two folds in three."""
    docs = table(spark, sf_dir, "documents")
    return langid.identified(docs, langid.learned(docs)).select("doc_id", _fold(3, 1), "lang_pred", "score")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents with equal texts."""
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The probability of every document after raking, and whether it is picked."""
    rows = mixed(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        F.col("_source").alias("source"),
        F.col("_lang").alias("lang"),
        F.col("_topic").alias("topic"),
        F.col("_tokens").cast("long").alias("n_tokens"),
        F.col("_probability").alias("probability"),
        F.col("_picked").alias("picked"),
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without later repeats of runs of 50 words or more, as hashes, and the numbers of the lines removed."""
    rows = line_dedup(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        F.size("removed").cast("long").alias("n_removed"),
        F.array_join("removed", ",").alias("removed_lines"),
        F.sha2("text", 256).alias("clean_sha256"),
    )


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many vectors of its label each vector is linked to by a cosine of 0.98 or more, and its component."""
    return near_vectors(table(spark, sf_dir, "embeddings")).drop("label")


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two tokenizers' tokens of every text are aligned, and how often its links stand in all texts."""
    first, second = (Path(public_tokenizers.path(name)) for name in ALIGNED)
    return alignment.aligned(table(spark, sf_dir, "documents"), first.read_text("utf-8"), second.read_bytes(), public_tokenizers.PATTERN)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words one edit from a far more frequent word, and the word that such forms lead to."""
    return spelling_variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash_near_dedup": op1_simhash_near_dedup,
        "op2_winnowing": op2_winnowing,
        "op3_sharding": op3_sharding,
        "op4_bpe_round_trip": op4_bpe_round_trip,
        "op5_pii": op5_pii,
        "op6_quality": op6_quality,
        "op7_language_id": op7_language_id,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_mixing": op9_mixing,
        "op10_line_dedup": op10_line_dedup,
        "op11_embedding_near_dedup": op11_embedding_near_dedup,
        "op12_cross_tokenizer_alignment": op12_cross_tokenizer_alignment,
        "op13_spelling_variants": op13_spelling_variants,
    }


OP3_SQL = "SELECT doc_id, lang, source, n_chars, sha256(text) AS text_sha256 FROM documents"


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY body) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY body) AS kept,
       sha256(body) AS text_sha256
FROM d
"""


OP10_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents WHERE text <> ''),
n AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM l),
c AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM n),
g AS (
  SELECT a.doc_id, a.pos AS s, min(b.pos) AS e FROM c a JOIN c b
    ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.upto - a.upto + a.words >= 50 GROUP BY 1, 2
  UNION
  SELECT b.doc_id, max(a.pos), b.pos FROM c a JOIN c b
    ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.upto - a.upto + a.words >= 50 GROUP BY b.doc_id, b.pos),
t AS (
  SELECT g.doc_id, g.s, g.e, string_agg(l.line, chr(10) ORDER BY l.pos) AS run
  FROM g JOIN l ON l.doc_id = g.doc_id AND l.pos BETWEEN g.s AND g.e GROUP BY 1, 2, 3),
f AS (SELECT *, min((doc_id, s)) OVER (PARTITION BY run) AS origin FROM t),
x AS (SELECT DISTINCT f.doc_id, l.pos FROM f JOIN l ON l.doc_id = f.doc_id AND l.pos BETWEEN f.s AND f.e
      WHERE (f.doc_id, f.s) > origin),
k AS (
  SELECT l.doc_id, count(x.pos) AS n_removed,
         coalesce(string_agg(CAST(x.pos AS VARCHAR), ',' ORDER BY l.pos), '') AS removed_lines,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE x.pos IS NULL), '') AS body
  FROM l LEFT JOIN x ON x.doc_id = l.doc_id AND x.pos = l.pos GROUP BY 1)
SELECT d.doc_id, coalesce(n_removed, 0) AS n_removed, coalesce(removed_lines, '') AS removed_lines,
       sha256(CASE WHEN k.doc_id IS NULL THEN d.text ELSE body END) AS clean_sha256
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_sharding": OP3_SQL, "op8_exact_dedup": OP8_SQL, "op10_line_dedup": OP10_SQL}
