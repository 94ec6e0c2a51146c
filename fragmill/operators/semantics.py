"""Which classified fragments are kept, and which are not to be split further."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fragmill.operators.fragments import best_of, not_within
from fragmill.operators.matching import Pattern
from fragmill.operators.patterns import Atom, Structure, matches

# Priorities by kind, and the labels that the stop rules read.
PRIORITIES = {
    "amino_acid_residue": 1000,
    "amino_acid_side_chain": 950,
    "drug_feature_rule": 920,
    "murcko_scaffold": 800,
    "ring": 780,
    "functional_group": 650,
    "brics": 550,
    "path": 450,
    "sliding": 400,
    "connected_component": 100,
}
TELLING_GROUPS = ["nitro", "nitrile", "amide", "ester", "carboxyl", "sulfonyl", "sulfone", "phosphate", "phosphate_like", "disulfide"]
TELLING_CORES = ["fused_ring", "privileged_scaffold_candidate", "high_semantic_core"]
COMMON_CLASSES = [
    "amine", "basic_candidate", "hbond_acceptor", "hbond_donor", "heterocycle", "positive_ionizable_candidate", "ring_system",
    "saturated_aza_ring", "amide", "imine_like",
]
TELLING_LINKERS = ["conjugated_linker", "cleavable_linker_candidate", "disulfide_linker"]


def priority(kind: Column) -> Column:
    """The priority of a kind; null for unknown ones."""
    return F.create_map(*[F.lit(x) for pair in PRIORITIES.items() for x in pair])[kind]


def stop() -> Column:
    """struct<stop, reason> of a row (semantic_type, semantic_class array, priority, heavy_atoms, ring_count,
    aromatic_ring_count, rotatable_bonds, is_complete_residue, is_side_chain): the first rule that fits.

    Each kind has rules to stop, in order, and one reason for all that none of them fits.
    """
    kind, high, heavy, rings = (F.col(c) for c in ("semantic_type", "priority", "heavy_atoms", "ring_count"))
    some = lambda labels: F.arrays_overlap("semantic_class", F.array(*[F.lit(x) for x in labels]))
    has = lambda label: F.array_contains("semantic_class", label)
    ordinary = (heavy <= 5) & (rings <= 1) & (F.size(F.array_except("semantic_class", F.array(*[F.lit(x) for x in COMMON_CLASSES]))) == 0)
    rules = [
        ((kind == "amino_acid_residue") | F.col("is_complete_residue"), True, "complete_amino_acid_residue"),
        ((kind == "amino_acid_side_chain") | F.col("is_side_chain"), True, "recognized_amino_acid_side_chain"),
        ((kind == "module") & some(TELLING_CORES), True, "privileged_or_fused_module"),
        (
            (kind == "module")
            & ((has("aromatic_heterocycle") & (high >= 85)) | (has("ring_system") & (heavy >= 5) & (rings >= 1) & (high >= 85)) | ((high >= 88) & (heavy >= 5) & ~ordinary)),
            True,
            "high_semantic_module",
        ),
        (kind == "module", False, "small_common_module_without_distinctive_semantic_density"),
        ((kind == "linker") & some(TELLING_LINKERS), True, "cleavable_or_conjugated_linker"),
        (
            (kind == "linker") & ((has("rigid_linker") & (heavy >= 4)) | (has("flexible_linker") & (heavy >= 5) & (F.col("rotatable_bonds") >= 2))),
            True,
            "distinctive_linker_unit",
        ),
        (kind == "linker", False, "short_low_information_linker"),
        ((kind == "functional_group") & some(TELLING_GROUPS), True, "high_semantic_functional_group"),
        ((kind == "functional_group") & (high >= 45) & (heavy >= 4), True, "medium_complex_functional_group"),
        ((kind == "functional_group") & (has("small_group") | (heavy <= 2)), False, "small_low_information_group"),
        (kind == "functional_group", False, "default_functional_group"),
        ((high >= 90) & ((rings >= 1) | (F.col("aromatic_ring_count") >= 1) | (heavy >= 6)), True, "fallback_high_priority_semantic_unit"),
    ]
    found = None
    for test, stops, reason in rules:
        value = F.struct(F.lit(stops).alias("stop"), F.lit(reason).alias("reason"))
        found = F.when(test, value) if found is None else found.when(test, value)
    return found.otherwise(F.struct(F.lit(False).alias("stop"), F.lit("default_fallback_non_terminal_unit").alias("reason")))


def low_information(heavy: Column, rings: Column, carbons: Column) -> Column:
    """Two heavy atoms or fewer, or an open chain of up to four carbons."""
    return (heavy <= 2) | ((heavy <= 4) & (rings == 0) & F.coalesce(carbons == heavy, F.lit(False)))


def informative_path(heavy: Column, carbons: Column, aromatic: Column, rings: Column, least: int = 3, carbon: bool = True) -> Column:
    """Whether a path says something: large enough, with a carbon (if asked for) and something else, and not a part of an aromatic ring that is cut open."""
    has_carbon = (carbons > 0) if carbon else F.lit(True)
    return (heavy >= least) & (heavy > 2) & has_carbon & (carbons < heavy) & ~((aromatic > 0) & (rings == 0))


def features(rows: DataFrame, indication: str, fragment: str) -> DataFrame:
    """(indication, fragment) of rules, trimmed and once each; blank ones are dropped."""
    trimmed = rows.select(F.trim(indication).alias("indication"), F.trim(fragment).alias("fragment"))
    return trimmed.where("indication <> '' and fragment <> ''").distinct()


def feature_matches(indications: DataFrame, rules: DataFrame, patterns: dict[str, Pattern], atoms: DataFrame, bonds: DataFrame) -> DataFrame:
    """(molecule_id, source, fragment, atoms) for each place where a fragment fits that a rule names for one of the molecule's indications.

    indications has (molecule_id, indication), rules (indication, fragment);
    patterns gives the shape of each fragment, and one without a shape never fits.
    Places with the same atoms count once. Only molecules that a rule asks for are
    looked at, and all shapes at once: the plan does not grow with the rules.
    """
    if not patterns:
        raise ValueError("no pattern is given")
    asked = indications.select("molecule_id", "indication").distinct().join(rules, "indication")
    ids = asked.select("molecule_id").distinct()
    shapes = [Structure(name, tuple((Atom((label,)),) for label in p.labels), tuple((i, j, ()) for i, j in p.bonds)) for name, p in patterns.items()]
    found = matches(shapes, atoms.join(ids, "molecule_id", "left_semi"), bonds.join(ids, "molecule_id", "left_semi"))
    places = found.select("molecule_id", F.col("name").alias("fragment"), F.array_sort("atoms").alias("atoms"))
    return asked.join(places, ["molecule_id", "fragment"]).select("molecule_id", F.concat(F.lit("drug_feature:"), "indication").alias("source"), "fragment", "atoms")


def resolved(candidates: DataFrame, molecule: str = "molecule_id") -> DataFrame:
    """The candidates that are kept: informative ones that are no part of a residue (rules of a drug's features excepted), then the best of each atom set and of each SMILES.

    candidates has atoms (sorted array), smiles, kind, priority, is_protected,
    is_complete_residue, heavy_atoms, rings and carbons.
    """
    rows = candidates.where(~low_information(F.col("heavy_atoms"), F.col("rings"), F.col("carbons")))
    exempt = (F.col("kind") == "drug_feature_rule") | F.col("is_complete_residue")
    residues = candidates.where("is_complete_residue")
    free = rows.where(exempt).unionByName(not_within(rows.where(~exempt), residues, molecule))
    return best_of(free, molecule, "atoms", "smiles")
