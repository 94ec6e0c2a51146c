"""Exact duplicates: groups of equal texts, found by a 128-bit hash and proven by their bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, joined


def squeezed(text: Column) -> Column:
    """The text with every run of ASCII white space as one space; null is the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row.

    Texts are grouped by the MD5 of their squeezed form and, within a hash, by
    the bytes themselves, so two texts that collide stay apart. The smallest id of
    a group stays. Equal texts are pre-aggregated where they are read, so a group
    that holds a third of all rows costs its readers one row each, and its rows
    are dealt to all tasks when they learn their group.

    Null texts are empty texts. Rows with one id stay separate rows, each kept if
    its id is the smallest; a null id is kept only if its whole group has none.
    Other columns are not read, whatever their names; no rows give no rows.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), squeezed(F.col(text_col)).alias("body"))
    rows = rows.withColumn("h", F.unhex(F.md5("body")))
    texts = rows.groupBy("h", "body").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    # One row for each text, without the text unless its hash is shared.
    classes = cut(texts.select("h", F.sha2("body", 256).alias("text_sha256"), "keep_id", "group_size", F.col("group_size").alias("n")))
    shared = classes.groupBy("h").count().where("count > 1").select("h")
    plain = rows.select("doc_id", "h")
    if shared.isEmpty():
        found = joined(plain, classes, ["h"])
    else:
        alone = joined(plain, classes.join(shared, "h", "left_anti"), ["h"])
        apart = rows.join(shared, "h").withColumn("text_sha256", F.sha2("body", 256))
        collided = texts.join(shared, "h").select("h", "body", "keep_id", "group_size")
        found = alone.unionByName(
            apart.join(collided, ["h", "body"]).select("doc_id", "h", "text_sha256", "keep_id", "group_size")
        )
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
