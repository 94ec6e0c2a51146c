"""Connected fragments of many graphs, enumerated by joins."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragmill.functions.rings import smallest_rings
from fragmill.session import settled


def with_bond_numbers(bonds: DataFrame) -> DataFrame:
    """bonds (molecule_id, a, b) with bond, their number from 0 within a molecule."""
    order = Window.partitionBy("molecule_id").orderBy("a", "b")
    return bonds.withColumn("bond", F.row_number().over(order) - 1)


def super_units(bonds: DataFrame) -> DataFrame:
    """Bonds with unit: ordinary bonds have their own, bonds of one aromatic system share its smallest.

    bonds has (molecule_id, bond, a, b, system), system null for ordinary bonds. A
    fragment takes a whole system or none of it.
    """
    lead = F.min("bond").over(Window.partitionBy("molecule_id", "system"))
    return bonds.withColumn("unit", F.when(F.col("system").isNull(), F.col("bond")).otherwise(lead))


def closed(units: DataFrame, systems: DataFrame | None = None) -> DataFrame:
    """(molecule_id, unit, has, own): of each unit, the units that come with it and all their atoms.

    systems (molecule_id, unit) are aromatic systems: a unit that touches one of
    their atoms brings the whole of it, so that no fragment holds a part.
    """
    whole = units.groupBy("molecule_id", "unit").agg(F.array_sort(F.collect_set("atom")).alias("own"))
    if systems is None:
        return whole.select("molecule_id", "unit", F.array("unit").alias("has"), "own")
    rings = units.join(systems.distinct(), ["molecule_id", "unit"]).select("molecule_id", "atom", F.col("unit").alias("ring"))
    touched = units.join(rings, ["molecule_id", "atom"]).select("molecule_id", "unit", "ring").distinct()
    bodies = whole.select("molecule_id", F.col("unit").alias("ring"), F.col("own").alias("body"))
    brought = touched.join(bodies, ["molecule_id", "ring"]).groupBy("molecule_id", "unit").agg(
        F.collect_set("ring").alias("rings"), F.flatten(F.collect_list("body")).alias("bodies")
    )
    return whole.join(brought, ["molecule_id", "unit"], "left").select(
        "molecule_id",
        "unit",
        F.array_sort(F.array_union(F.array("unit"), F.coalesce("rings", F.array("unit")))).alias("has"),
        F.array_sort(F.array_union("own", F.coalesce("bodies", "own"))).alias("own"),
    )


def enumerated(units: DataFrame, max_atoms: int, systems: DataFrame | None = None) -> DataFrame:
    """(molecule_id, units, atoms) of every connected, not necessarily induced, set of units with at most so many atoms.

    units has (molecule_id, unit, atom), a row for each atom of a unit; systems
    (molecule_id, unit) are taken whole or not at all (see closed). A set is told by
    its ordinary units, as these bring the systems they touch, or is one system
    alone. Sets of ordinary units grow from their smallest, each unit once as the
    smallest: a set has a list of units that may join it, joining one drops those
    before it in the list and adds what only the new one touches. So every set is
    made once, from one other, and no round looks for sets that came twice. All
    rounds keep the one partitioning by molecule, and a set that is too large is not
    followed: a larger set holds it.
    """
    whole = closed(units, systems)
    alone = whole.limit(0) if systems is None else whole.join(systems.distinct(), ["molecule_id", "unit"], "left_semi")
    ordinary = whole if systems is None else whole.join(systems.distinct(), ["molecule_id", "unit"], "left_anti")
    molecules = ordinary.groupBy("molecule_id").agg(F.array_sort(F.collect_list(F.struct("unit", "has", "own"))).alias("items"))
    beside = F.transform("items", lambda x, i: F.filter(F.sequence(F.lit(0), F.size("items") - 1), lambda j: (j != i) & F.arrays_overlap(x["own"], F.get("items", j)["own"])))
    molecules = settled(molecules.withColumn("near", beside))
    each = molecules.select("molecule_id", "near", F.posexplode("items").alias("root", "x"))
    near = F.get("near", F.col("root"))
    level = each.select(
        "molecule_id", "root", F.col("x.has").alias("units"), F.col("x.own").alias("atoms"),
        F.array_append(near, F.col("root")).alias("seen"), F.filter(near, lambda j: j > F.col("root")).alias("ahead"),
    ).where(F.size("atoms") <= max_atoms)
    level, found = settled(level), []
    while True:
        found.append(level.select("molecule_id", "units", "atoms"))
        joins = level.where(F.size("ahead") > 0).join(molecules, "molecule_id").select("*", F.posexplode("ahead").alias("at", "new"))
        item, beyond = F.get("items", F.col("new")), F.get("near", F.col("new"))
        atoms = F.array_union("atoms", item["own"])
        own = F.filter(F.array_except(beyond, "seen"), lambda j: j > F.col("root"))
        grown = joins.where(F.size(atoms) <= max_atoms).select(
            "molecule_id", "root", F.array_union("units", item["has"]).alias("units"), atoms.alias("atoms"),
            F.array_union("seen", beyond).alias("seen"), F.concat(F.slice("ahead", F.col("at") + 2, F.size("ahead")), own).alias("ahead"),
        )
        level = settled(grown)
        if level.isEmpty():
            break
    out = alone.where(F.size("own") <= max_atoms).select("molecule_id", F.array("unit").alias("units"), F.col("own").alias("atoms"))
    for rows in found:
        out = out.unionByName(rows)
    return out.select("molecule_id", F.array_sort("units").alias("units"), F.array_sort("atoms").alias("atoms"))


def labelled(fragments: DataFrame, atoms: DataFrame) -> DataFrame:
    """fragments with formula, their atoms' labels counted and sorted, such as "C6 O"."""
    each = fragments.withColumn("atom", F.explode("atoms")).join(atoms.select("molecule_id", "atom", "label"), ["molecule_id", "atom"])
    counts = each.groupBy("molecule_id", "units", "label").count()
    part = F.concat("label", F.when(F.col("count") > 1, F.col("count").cast("string")).otherwise(F.lit("")))
    return counts.groupBy("molecule_id", "units").agg(F.array_join(F.array_sort(F.collect_list(part)), " ").alias("formula"))


def best_of(candidates: DataFrame, molecule: str, atom_key: str, label: str) -> DataFrame:
    """One candidate for each atom set, then one for each label: the highest priority, protected, largest first."""
    order = [F.col("priority").desc(), F.col("is_protected").desc(), F.col("heavy_atoms").desc(), "kind", atom_key]
    first = lambda rows, key: rows.withColumn(
        "_n", F.row_number().over(Window.partitionBy(molecule, key).orderBy(*order))
    ).where("_n = 1").drop("_n")
    return first(first(candidates, atom_key), label)


def not_within(parts: DataFrame, residues: DataFrame, molecule: str) -> DataFrame:
    """parts whose atoms are not a proper subset of those of one of their molecule's residues."""
    inside = (F.size(F.array_except("atoms", "_residue")) == 0) & (F.size("atoms") < F.size("_residue"))
    held = residues.select(F.col(molecule).alias("_m"), F.col("atoms").alias("_residue"))
    return parts.join(held.hint("merge"), (F.col(molecule) == F.col("_m")) & inside, "left_anti")


def connected_atoms(bonds: DataFrame, least: int, most: int) -> DataFrame:
    """(molecule_id, atoms) of every connected set of atoms, with all bonds among them, of a size from least to most."""
    ways = bonds.select("molecule_id", "a", "b").union(bonds.select("molecule_id", F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    level = ways.select("molecule_id", F.array("a").alias("atoms")).distinct()
    found = level
    for _ in range(most - 1):
        level = (
            level.withColumn("a", F.explode("atoms"))
            .join(ways.hint("merge"), ["molecule_id", "a"])
            .where(~F.array_contains("atoms", F.col("b")))
            .select("molecule_id", F.array_sort(F.array_append("atoms", F.col("b"))).alias("atoms"))
            .distinct()
        )
        found = found.unionByName(level)
    return found.where(F.size("atoms") >= least)


def part_of(atoms: Column, bonds: Column) -> Column:
    """For each of the atoms (array) of one molecule the least atom of its connected part, by bonds (array of a, b) that join labels one after another; a bond to an atom that is not there joins nothing."""

    def joined(labels: Column, bond: Column) -> Column:
        x, y = (F.get(labels, (F.array_position(atoms, bond[end]) - 1).cast("int")) for end in ("a", "b"))
        return F.transform(labels, lambda l: F.when(l == F.greatest(x, y), F.least(x, y)).otherwise(l))  # noqa: E741

    pairs = F.transform(bonds, lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b")))
    return F.coalesce(F.aggregate(pairs, atoms, joined), atoms)


def parts(atoms: Column, bonds: Column) -> Column:
    """How many connected parts the atoms of one molecule have."""
    return F.size(F.array_distinct(part_of(atoms, bonds)))


def _of_molecules(atoms: DataFrame, bonds: DataFrame) -> DataFrame:
    """(molecule_id, _atoms, _bonds): a row for each molecule that has atoms."""
    pairs = bonds.groupBy("molecule_id").agg(F.collect_list(F.struct(F.col("a").cast("int").alias("a"), F.col("b").cast("int").alias("b"))).alias("_bonds"))
    return atoms.groupBy("molecule_id").agg(F.array_sort(F.collect_set(F.col("atom").cast("int"))).alias("_atoms")).join(pairs.hint("merge"), "molecule_id", "left")


def uncovered_parts(atoms: DataFrame, bonds: DataFrame, covered: DataFrame) -> DataFrame:
    """(molecule_id, atoms) of every connected part of the atoms that no row of covered (molecule_id, atom) has."""
    left = atoms.join(covered.select("molecule_id", "atom").distinct().hint("merge"), ["molecule_id", "atom"], "left_anti")
    rows = _of_molecules(left, bonds).select("molecule_id", F.explode(F.arrays_zip(part_of(F.col("_atoms"), F.col("_bonds")).alias("part"), F.col("_atoms").alias("atom"))).alias("x"))
    return rows.groupBy("molecule_id", "x.part").agg(F.array_sort(F.collect_list("x.atom")).alias("atoms")).drop("part")


def path_metrics(paths: DataFrame, atoms: DataFrame, bonds: DataFrame, carbons: tuple[str, ...], aromatic: tuple[str, ...]) -> DataFrame:
    """paths (molecule_id, path) with heavy_atoms, carbon_atoms, aromatic_atoms and rings, the bonds among a path's atoms beyond those that hold it together."""
    labels = atoms.groupBy("molecule_id").agg(F.map_from_entries(F.collect_list(F.struct("atom", "label"))).alias("_labels"))
    pairs = bonds.groupBy("molecule_id").agg(F.collect_set(F.struct(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).alias("_bonds"))
    rows = paths.join(labels.hint("merge"), "molecule_id").join(pairs.hint("merge"), "molecule_id", "left")
    count = lambda names: F.size(F.filter("path", lambda a: F.element_at("_labels", a).isin(*names)))
    among = F.size(F.filter(F.coalesce("_bonds", F.array().cast(pairs.schema["_bonds"].dataType)), lambda x: F.array_contains("path", x["a"]) & F.array_contains("path", x["b"])))
    return rows.select(*paths.columns, F.size("path").alias("heavy_atoms"), count(carbons).alias("carbon_atoms"), count(aromatic).alias("aromatic_atoms"), (among - F.size("path") + 1).alias("rings"))


def shapes(bonds: DataFrame, atoms: DataFrame, carbons: tuple[str, ...] = ("C",)) -> DataFrame:
    """(molecule_id, heavy_atoms, bonds, rings, branches, hetero_atoms): rings are independent ones, branches each bond of an atom beyond two."""
    ends = bonds.select("molecule_id", F.explode(F.array("a", "b")).alias("atom")).groupBy("molecule_id", "atom").count()
    degrees = ends.groupBy("molecule_id").agg(F.sum(F.greatest(F.col("count") - 2, F.lit(0))).alias("branches"))
    sizes = atoms.groupBy("molecule_id").agg(F.count("*").alias("heavy_atoms"), F.count_if(~F.col("label").isin(*carbons)).alias("hetero_atoms"))
    rows = sizes.join(degrees, "molecule_id", "left").join(_of_molecules(atoms, bonds), "molecule_id", "left")
    count = F.coalesce(F.size("_bonds").cast("long"), F.lit(0))
    rings = count - F.col("heavy_atoms") + parts(F.col("_atoms"), F.col("_bonds"))
    return rows.select("molecule_id", "heavy_atoms", F.greatest(count, F.lit(0)).alias("bonds"), F.greatest(rings, F.lit(0)).alias("rings"), F.coalesce("branches", F.lit(0)).alias("branches"), "hetero_atoms")


def simple_paths(bonds: DataFrame, least: int, most: int) -> DataFrame:
    """(molecule_id, path) of every path without a repeated atom, of a size from least to most, once: it begins at its smaller end."""
    ways = bonds.select("molecule_id", "a", "b").union(bonds.select("molecule_id", F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    level = ways.select("molecule_id", F.array("a").alias("path")).distinct()
    found = None
    for size in range(2, most + 1):
        level = (
            level.withColumn("a", F.element_at("path", -1)).join(ways.hint("merge"), ["molecule_id", "a"])
            .where(~F.array_contains("path", F.col("b")))
            .select("molecule_id", F.array_append("path", F.col("b")).alias("path"))
        )
        if size >= least:
            found = level if found is None else found.unionByName(level)
    return found.where(F.element_at("path", 1) < F.element_at("path", -1))


def atom_paths(bonds: DataFrame, least: int, most: int) -> DataFrame:
    """(molecule_id, path) of the atoms of simple paths, sorted, each set of atoms once."""
    return simple_paths(bonds, least, most).select("molecule_id", F.array_sort("path").alias("path")).distinct()


@F.pandas_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
def _ring_atoms(molecules: pd.Series) -> pd.Series:
    out = []
    for bonds in molecules:
        pairs = [(x["a"], x["b"]) for x in bonds]
        out.append([sorted({a for k in ring for a in pairs[k]}) for ring in smallest_rings(pairs)])
    return pd.Series(out)


def ring_fragments(bonds: DataFrame) -> DataFrame:
    """(molecule_id, atoms) of each ring of a smallest set that all other rings are made of; outlines of fused rings are not in it."""
    pairs = F.struct(F.least("a", "b").cast("int").alias("a"), F.greatest("a", "b").cast("int").alias("b"))
    each = bonds.groupBy("molecule_id").agg(F.array_sort(F.collect_set(pairs)).alias("_bonds")).where(F.size("_bonds") > 2)
    return each.select("molecule_id", F.explode(_ring_atoms("_bonds")).alias("atoms"))


def not_all_carbon(atoms: DataFrame, carbons: tuple[str, ...] = ("C",)) -> DataFrame:
    """(molecule_id) of those with an atom that is no carbon."""
    return atoms.where(~F.col("label").isin(*carbons)).select("molecule_id").distinct()


def witnesses(rows: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """For each key its smallest row by the given columns."""
    least = rows.groupBy(*keys).agg(F.min(F.struct(*by)).alias("_w"))
    return least.select(*keys, "_w.*")
