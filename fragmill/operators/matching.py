"""Substructures of many molecules at once: patterns matched by joins, and signatures by rounds of neighbours."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Pattern:
    """A connected pattern: a label for each atom, and bonds (i, j) between them."""

    labels: tuple[str, ...]
    bonds: tuple[tuple[int, int], ...] = ()

    def ordered(self) -> list[tuple[int, int, bool]]:
        """Bonds so that each begins at an atom placed before; with whether it also ends at one."""
        left, placed, out = list(self.bonds), {0}, []
        while left:
            bond = next((b for b in left if placed & set(b)), None)
            if bond is None:
                raise ValueError("the pattern is not connected")
            left.remove(bond)
            i, j = bond if bond[0] in placed else bond[::-1]
            out.append((i, j, j in placed))
            placed |= {i, j}
        if placed != set(range(len(self.labels))):
            raise ValueError("the pattern is not connected")
        return out


def both_ways(bonds: DataFrame) -> DataFrame:
    """(molecule_id, a, b) in either direction, once each."""
    return bonds.select("molecule_id", "a", "b").union(bonds.select("molecule_id", F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def embeddings(pattern: Pattern, atoms: DataFrame, bonds: DataFrame) -> DataFrame:
    """(molecule_id, at): where the pattern's atoms lie, in its order, for each way it fits.

    The first atom is looked up by label; each bond then is a join on the
    molecule and an atom placed before, so that work follows the matches there are
    and molecules are spread over all tasks.
    """
    atoms, ways = atoms.select("molecule_id", "atom", "label"), both_ways(bonds)
    places = {0: 0}
    rows = atoms.where(F.col("label") == pattern.labels[0]).select("molecule_id", F.array("atom").alias("at"))
    ends = ways.join(atoms.withColumnRenamed("atom", "b").withColumnRenamed("label", "_label"), ["molecule_id", "b"])
    for i, j, closes in pattern.ordered():
        step = ends.where(F.col("_label") == pattern.labels[j]).select("molecule_id", F.col("a").alias("_a"), F.col("b").alias("_b"))
        rows = rows.withColumn("_a", F.get("at", F.lit(places[i]))).join(step, ["molecule_id", "_a"])
        if closes:
            rows = rows.where(F.get("at", F.lit(places[j])) == F.col("_b")).select("molecule_id", "at")
        else:
            places[j] = len(places)
            rows = rows.where(~F.array_contains("at", F.col("_b"))).select("molecule_id", F.array_append("at", F.col("_b")).alias("at"))
    order = [F.get("at", F.lit(places[k])) for k in range(len(pattern.labels))]
    return rows.select("molecule_id", F.array(*order).alias("at"))


def disjoint(patterns: list[Pattern], atoms: DataFrame, bonds: DataFrame) -> DataFrame:
    """(molecule_id) of molecules that hold all patterns at once, no two of them on one atom.

    Each pattern's places are reduced to different atom sets first. Sets are
    joined by molecule, each new one apart from those before; equal unions are
    kept once, so that one molecule's choices do not multiply without need.
    """
    rows = None
    for pattern in sorted(patterns, key=lambda p: -len(p.labels)):
        sets = embeddings(pattern, atoms, bonds).select("molecule_id", F.array_sort("at").alias("_set")).distinct()
        if rows is None:
            rows = sets.withColumnRenamed("_set", "used")
        else:
            both = rows.join(sets, "molecule_id").where(~F.arrays_overlap("used", "_set"))
            rows = both.select("molecule_id", F.array_sort(F.concat("used", "_set")).alias("used")).distinct()
    return rows.select("molecule_id").distinct()


def signatures(fragments: DataFrame, atoms: DataFrame, bonds: DataFrame, rounds: int) -> DataFrame:
    """fragments (molecule_id, units, atoms) with signature: equal for fragments of one shape.

    Each atom's label is hashed with those of its neighbours in the fragment, round
    by round; the signature is the hash of all, sorted. Different shapes of up to
    a few rounds' reach nearly always differ; that is a test for sameness by
    refinement, not a proof.
    """
    key = ["molecule_id", "units"]
    each = fragments.select(*key, F.explode("atoms").alias("atom")).join(atoms.select("molecule_id", "atom", "label"), ["molecule_id", "atom"])
    pairs = fragments.join(both_ways(bonds), "molecule_id").where(F.array_contains("atoms", F.col("a")) & F.array_contains("atoms", F.col("b")))
    pairs = pairs.select(*key, F.col("a").alias("atom"), F.col("b").alias("beside"))
    for _ in range(rounds):
        other = each.select(*key, F.col("atom").alias("beside"), F.col("label").alias("_other"))
        near = pairs.join(other, [*key, "beside"]).groupBy(*key, "atom").agg(F.array_join(F.array_sort(F.collect_list("_other")), ",").alias("_near"))
        each = each.join(near, [*key, "atom"], "left").withColumn("label", F.sha2(F.concat_ws("|", "label", F.coalesce("_near", F.lit(""))), 256))
        each = each.drop("_near")
    found = each.groupBy(*key).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("label")), ","), 256).alias("signature"))
    return fragments.join(found, key)
