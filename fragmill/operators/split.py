"""From molecules to their telling fragments: all kinds of fragments of all molecules, and which of them are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fragmill.functions import smiles as S
from fragmill.functions.canonical import fragment_smiles
from fragmill.operators import fragments, patterns, semantics, skeletons
from fragmill.session import settled

_COLUMNS = ["molecule_id", "atoms", "kind", "semantic_type", "label", "is_protected", "is_complete_residue"]


def _as(rows: DataFrame, semantic_type: str, label=None, protected: bool = False, complete: bool = False) -> DataFrame:
    label = F.lit("") if label is None else label
    kind = F.concat_ws(":", F.lit(semantic_type), F.nullif(label, F.lit("")))
    flags = F.lit(protected).alias("is_protected"), F.lit(complete).alias("is_complete_residue")
    return rows.select("molecule_id", F.array_sort("atoms").alias("atoms"), kind.alias("kind"), F.lit(semantic_type).alias("semantic_type"), label.alias("label"), *flags)


def candidates(rows: DataFrame, paths: tuple[int, int] = (3, 10)) -> DataFrame:
    """(molecule_id, atoms, kind, semantic_type, label, is_protected, is_complete_residue) of all fragments of rows with molecule and rings.

    Residues and their side chains come first; functional groups, scaffolds, rings,
    parts between cuts and telling paths of so many atoms are taken from the atoms
    that no residue covers. A molecule without any gives its uncovered parts. No
    join takes what comes of molecules to be small, so none reaches the driver.
    """
    rows = settled(rows.where(F.col("molecule.atoms").isNotNull()).select("molecule_id", "molecule", "rings"))
    residues = settled(skeletons.residues(rows))
    atoms, bonds = S.atoms_of(rows), S.bonds_of(rows)
    covered = residues.select("molecule_id", F.explode("atoms").alias("atom")).distinct()
    free = atoms.join(covered.hint("merge"), ["molecule_id", "atom"], "left_anti").withColumn("label", F.when(F.col("aromatic"), F.lower("label")).otherwise(F.col("label")))
    ends = covered.withColumnRenamed("atom", "_end")
    inner = bonds
    for end in ("a", "b"):
        inner = inner.join(ends.withColumnRenamed("_end", end).hint("merge"), ["molecule_id", end], "left_anti")
    walks = fragments.path_metrics(fragments.atom_paths(inner.select("molecule_id", "a", "b"), *paths), free, inner, ("C", "c"), ("b", "c", "n", "o", "p", "s"))
    telling = walks.where(semantics.informative_path(*map(F.col, ("heavy_atoms", "carbon_atoms", "aromatic_atoms", "rings")))).select("molecule_id", F.col("path").alias("atoms"))
    found = patterns.matches(patterns.FUNCTIONAL_GROUPS, atoms, bonds)
    generic = (
        _as(found, "functional_group", F.col("name")).unionByName(_as(skeletons.scaffold(rows), "murcko_scaffold"))
        .unionByName(_as(rows.select("molecule_id", F.explode("rings.atoms").alias("atoms")), "ring")).unionByName(_as(skeletons.cut_parts(rows), "brics"))
    )
    taken = covered.groupBy("molecule_id").agg(F.collect_set("atom").alias("_covered"))
    generic = generic.join(taken.hint("merge"), "molecule_id", "left").where(F.coalesce(~F.arrays_overlap("atoms", "_covered"), F.lit(True))).drop("_covered")
    own = _as(residues, "amino_acid_residue", F.col("name"), True, True).unionByName(_as(residues.select("molecule_id", "name", F.col("side_chain").alias("atoms")).where(F.size("atoms") > 0), "amino_acid_side_chain", F.col("name"), True))
    every = settled(own.unionByName(generic).unionByName(_as(telling, "path")))
    bare = rows.select("molecule_id").join(every.select("molecule_id").distinct().hint("merge"), "molecule_id", "left_anti").hint("merge")
    parts = fragments.uncovered_parts(atoms.join(bare, "molecule_id", "left_semi"), bonds.join(bare, "molecule_id", "left_semi"), covered)
    return every.unionByName(_as(parts, "connected_component")).select(_COLUMNS)


def semantic_split(rows: DataFrame, paths: tuple[int, int] = (3, 10)) -> DataFrame:
    """The fragments of molecules that are kept, with their canonical text, metrics, priority and whether to split them further.

    Fragments of little information and proper parts of a residue go; of equal atom
    sets, then of equal texts of one molecule, the first by priority, protection and
    size stays. rows: molecule_id, molecule and rings; a null molecule has no
    fragments.
    """
    rows = settled(rows.select("molecule_id", "molecule", "rings"))
    measured = skeletons.subset_metrics(candidates(rows, paths), rows).join(rows.select("molecule_id", "molecule").hint("merge"), "molecule_id")
    carbons = F.size(F.filter("atoms", lambda a: F.get("molecule.atoms", a)["label"] == "C"))
    judged = measured.select(
        *_COLUMNS, "heavy_atoms", "ring_count", "aromatic_ring_count", "has_benzene", carbons.alias("carbons"), F.col("ring_count").alias("rings"),
        fragment_smiles(F.col("molecule.atoms"), F.col("molecule.bonds"), F.col("atoms")).alias("smiles"),
        F.array("label").alias("semantic_class"), (F.col("semantic_type") == "amino_acid_side_chain").alias("is_side_chain"), F.lit(0).alias("rotatable_bonds"),
        F.when(F.col("semantic_type") != "functional_group", semantics.priority(F.col("semantic_type"))).when(F.col("label").isin("nitro", "nitrile", "amide", "carboxyl"), 50).otherwise(25).alias("priority"),
    )
    told = F.when(F.col("semantic_type").isin("functional_group", "amino_acid_residue", "amino_acid_side_chain"), semantics.stop())
    judged = judged.withColumn("_stop", told).withColumn("priority", semantics.priority(F.col("semantic_type")))
    judged = judged.withColumn("stop_decompose", F.coalesce("_stop.stop", F.lit(False))).withColumn("stop_reason", F.coalesce("_stop.reason", F.lit("default_fallback_non_terminal_unit")))
    kept = semantics.resolved(judged)
    return kept.select(*_COLUMNS, "smiles", "priority", "heavy_atoms", "rings", "aromatic_ring_count", "has_benzene", "stop_decompose", "stop_reason")
