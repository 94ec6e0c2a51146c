"""The fragment warehouse: distinct fragments, mergeable aggregate states and the unified view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["molecule_id", "fragment_hash"]
CARRIED = ["canonical_smiles", "atom_count", "bond_count"]


def non_blank(fragments: DataFrame) -> DataFrame:
    """Fragments with a SMILES; nulls go too."""
    return fragments.where(F.col("canonical_smiles") != "")


def states(ingest: DataFrame, *more: str) -> DataFrame:
    """One state for each key (and each value of more, such as a batch): carried columns and a count.

    Carried columns depend on the hash alone, so their minimum is any of them. The
    aggregate is partial where rows are read, so a hot key costs a row a task.
    """
    carried = [F.min(c).alias(c) for c in CARRIED]
    return ingest.groupBy(*KEYS, *more).agg(*carried, F.count("*").alias("occurrence_count"))


def merged(parts: DataFrame) -> DataFrame:
    """States of one key merged: the same as if all rows had come at once."""
    carried = [F.min(c).alias(c) for c in CARRIED]
    return parts.groupBy(*KEYS).agg(*carried, F.sum("occurrence_count").alias("occurrence_count"))


def with_ingredients(fragments: DataFrame, ingredients: DataFrame, blank: bool = False, dedupe: bool = False) -> DataFrame:
    """Every fragment with its molecule's ingredients, null (or '', if blank) where there is none.

    Ingredients that stand several times multiply rows, unless dedupe is set.
    """
    names = ingredients.select("molecule_id", "ingredient_name")
    found = fragments.join(names.distinct() if dedupe else names, "molecule_id", "left")
    return found.withColumn("ingredient_name", F.coalesce("ingredient_name", F.lit(""))) if blank else found


def all_unique(small: DataFrame, big: DataFrame, ingredients: DataFrame) -> DataFrame:
    """The view over both builds: their distinct fragments with source and ingredient."""
    both = states(small).withColumn("source", F.lit("small")).unionByName(merged(big).withColumn("source", F.lit("big")))
    return with_ingredients(both, ingredients)


def of_ingredient(small: DataFrame, big: DataFrame, ingredients: DataFrame, name: str) -> DataFrame:
    """Distinct fragments of one ingredient in both builds.

    The join comes before the aggregate, so an ingredient that stands twice counts twice.
    """
    chosen = ingredients.where(F.col("ingredient_name") == name)
    first = F.min("ingredient_name").alias("ingredient_name")
    carried = [F.min(c).alias(c) for c in CARRIED]
    from_small = small.join(chosen, "molecule_id").groupBy(*KEYS).agg(first, *carried, F.count("*").alias("occurrence_count"))
    from_big = big.join(chosen, "molecule_id").groupBy(*KEYS).agg(first, *carried, F.sum("occurrence_count").alias("occurrence_count"))
    return from_small.withColumn("source", F.lit("small")).unionByName(from_big.withColumn("source", F.lit("big")))


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of old and new, those of new in place of old ones with their keys; all columns are replaced."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def replaced_version(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Every old row of a version that new brings goes before the new ones come."""
    return upserted(old, new, keys)


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one side that the other lacks, repeats counted, with the side they are on."""
    columns = left.columns
    right = right.select(columns)
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def with_views(spark: SparkSession, sql: str, **views: DataFrame | str) -> DataFrame:
    """A statement over named views, given as frames or as statements over other views; none outlives the statement.

    A {name} in a statement stands for a view. A view over views is expanded by the
    optimizer, so nothing is computed twice that its plan shares.
    """
    frames = {name: view for name, view in views.items() if isinstance(view, DataFrame)}
    waiting = {name: view for name, view in views.items() if not isinstance(view, DataFrame)}
    while waiting:
        ready = [name for name, view in waiting.items() if not any(f"{{{other}}}" in view for other in waiting)]
        if not ready:
            raise ValueError(f"views name each other: {sorted(waiting)}")
        for name in ready:
            frames[name] = spark.sql(waiting[name], **{n: f for n, f in frames.items() if f"{{{n}}}" in waiting[name]})
            del waiting[name]
    return spark.sql(sql, **{n: f for n, f in frames.items() if f"{{{n}}}" in sql})
