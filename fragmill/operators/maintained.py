"""The view of all unique fragments, kept up to date by signed changes instead of being computed anew."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FRAGMENT = ["source", "molecule_id", "fragment_hash", "canonical_smiles", "atom_count", "bond_count"]
INGREDIENT = ["molecule_id", "ingredient_name"]
_VIEW = ["source", "molecule_id", "fragment_hash", "ingredient_name", "canonical_smiles", "atom_count", "bond_count"]


class State(NamedTuple):
    """Fragments and ingredients, each different row once with n, how often it stands; the view with occurrence_count."""

    fragments: DataFrame
    ingredients: DataFrame
    view: DataFrame


def inserted(rows: DataFrame) -> DataFrame:
    """Changes that add the rows."""
    return rows.withColumn("n", F.lit(1).cast("long"))


def deleted(rows: DataFrame) -> DataFrame:
    """Changes that take the rows away, each once."""
    return rows.withColumn("n", F.lit(-1).cast("long"))


def replaced(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes from one version of rows to the next; what is in both cancels out."""
    return deleted(old).unionByName(inserted(new))


def folded(changes: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """The rows that changes leave, once each with their number; one that would be negative is an error."""
    sums = changes.groupBy(*keys).agg(F.sum(n).alias(n)).where(F.col(n) != 0)
    return sums.withColumn(n, F.when(F.col(n) > 0, F.col(n)).otherwise(F.raise_error(F.lit("a row is deleted more often than it stands"))))


def _joined(fragments: DataFrame, ingredients: DataFrame, sign: int = 1) -> DataFrame:
    """The view's rows of some fragments, signed; a molecule without an ingredient has null for one."""
    rows = fragments.join(ingredients.withColumnRenamed("n", "_m"), "molecule_id", "left")
    return rows.select(*_VIEW, (F.col("n") * F.coalesce("_m", F.lit(1)) * sign).alias("occurrence_count"))


def empty(fragments: DataFrame, ingredients: DataFrame) -> State:
    """The state before any row, with the types of the given tables."""
    none = fragments.select(*FRAGMENT).limit(0), ingredients.select(*INGREDIENT).limit(0)
    start = folded(inserted(none[0]), FRAGMENT), folded(inserted(none[1]), INGREDIENT)
    return State(*start, _joined(*start))


def changed(state: State, fragments: DataFrame | None = None, ingredients: DataFrame | None = None) -> State:
    """The state after signed changes of fragments (FRAGMENT, n) and ingredients (INGREDIENT, n).

    Fragments that come or go are joined to the ingredients as they were. Only of
    molecules whose ingredients change are all fragments read: their rows are taken
    from the view as they were and put in as they are. The view's counts are sums,
    so any order of changes gives the rows of a full computation. The result is a
    plan: write it, as a new version, before the next change.
    """
    none = lambda rows: rows.limit(0)
    df = (none(state.fragments) if fragments is None else fragments).select(*FRAGMENT, "n")
    di = (none(state.ingredients) if ingredients is None else ingredients).select(*INGREDIENT, "n")
    df, di = df.groupBy(*FRAGMENT).agg(F.sum("n").alias("n")).where("n <> 0"), di.groupBy(*INGREDIENT).agg(F.sum("n").alias("n")).where("n <> 0")
    after = folded(state.fragments.unionByName(df), FRAGMENT), folded(state.ingredients.unionByName(di), INGREDIENT)
    touched = di.select("molecule_id").distinct()
    of = lambda rows, how: rows.join(touched, "molecule_id", how)
    moves = (
        _joined(of(df, "left_anti"), state.ingredients)
        .unionByName(_joined(of(state.fragments, "left_semi"), of(state.ingredients, "left_semi"), -1))
        .unionByName(_joined(of(after[0], "left_semi"), of(after[1], "left_semi")))
    )
    return State(*after, folded(state.view.unionByName(moves), _VIEW, "occurrence_count"))


def written(state: State, folder: str) -> State:
    """The state as a new version below a folder that all executors share, read from there."""
    out = []
    for name, rows in state._asdict().items():
        rows.write.parquet(f"{folder}/{name}")
        out.append(rows.sparkSession.read.schema(rows.schema).parquet(f"{folder}/{name}"))
    return State(*out)
