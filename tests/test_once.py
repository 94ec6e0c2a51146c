"""Queries of molecules look at each different text once, and no table is broadcast for its small file."""

import pytest

from fragmill.functions import smiles as S
from fragmill.operators import graph, patterns, skeletons
from fragmill.plans import catalog


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def broadcasts(df) -> list[str]:
    """What stands below each broadcast of a plan."""
    lines, found = plan(df).split("\n"), []
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for n, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((m for m in range(n + 1, len(lines)) if depth(lines[m]) <= depth(line)), len(lines))
            found.append("\n".join(lines[n:end]))
    return found


def test_each_text_is_told_once(spark):
    seen = []

    def told(rows):
        seen.append([(r.molecule_id, r.smiles) for r in rows.collect()])
        return skeletons.scaffold(S.with_rings(S.molecules(rows))).selectExpr("molecule_id", "size(atoms) n")

    df = spark.createDataFrame([(5, "Cc1ccccc1"), (3, "Cc1ccccc1"), (4, "C1CC1"), (1, None), (2, "C("), (6, "CC"), (7, "C1CC1"), (8, None)], "molecule_id int, smiles string")
    found = S.once(df, told)
    assert sorted((r.molecule_id, r.n) for r in found.collect()) == [(3, 6), (4, 3), (5, 6), (7, 3)]
    assert sorted(seen[0], key=str) == sorted([(3, "Cc1ccccc1"), (4, "C1CC1"), (1, None), (2, "C("), (6, "CC")], key=str)
    assert "BroadcastExchange" not in plan(found)


@pytest.mark.parametrize("name", ["c18_residues", "e01_smiles_search", "c20_functional_groups", "c29_semantic_split", "c02_canonical_texts", "c15_scaffold_texts", "c17_subset_metrics"])
def test_query_reads_each_text_once(spark, sf, name, monkeypatch):
    seen, molecules = [], S.molecules

    def spy(rows, smiles="smiles"):
        seen.append(rows.select(smiles))
        return molecules(rows, smiles)

    monkeypatch.setattr(S, "molecules", spy)
    catalog.queries()[name](spark, sf)
    assert seen and all(rows.count() == rows.distinct().count() for rows in seen)


def test_molecules_are_not_broadcast_for_structures(spark):
    df = S.molecules(spark.createDataFrame([(1, "OCC#N"), (2, "c1ccsc1"), (3, "NCC(=O)O")], "molecule_id int, smiles string").repartition(2))
    found = patterns.matches(patterns.FUNCTIONAL_GROUPS, S.atoms_of(df), S.bonds_of(df))
    assert {(r.molecule_id, r.name) for r in found.collect()} == {(1, "hydroxyl"), (1, "nitrile"), (3, "carboxyl"), (3, "hydroxyl"), (3, "amine")}
    held = spark.range(3).selectExpr("id AS molecule_id", "CASE id WHEN 0 THEN 'N#CCC#N' WHEN 1 THEN 'CC#N' END AS smiles")
    rows = S.molecules(held)
    got = patterns.matches([patterns.Structure.of_smiles("CC#N")], S.atoms_of(rows), S.bonds_of(rows))
    # The steps are broadcast, from Python's rows; what the table gives is not.
    assert "Range" in plan(got) and not any("Range" in x for x in broadcasts(got))


def test_names_that_contain_terms_are_not_broadcast(spark, sf):
    names = spark.createDataFrame([(1, "Red Ring"), (2, "red ring"), (3, None), (4, "tin"), (5, "Red Ring")], "id int, name string")
    terms = spark.createDataFrame([("RING",), ("ring",), ("",), (None,), ("i",)], "term string")
    found = graph.containing(names, "name", terms, "term")
    assert found.columns == ["id", "name", "term"]
    assert sorted((r.id, r.term) for r in found.collect()) == sorted([(i, t) for i in (1, 2, 5) for t in ("RING", "ring", "i")] + [(4, "i")])
    part = spark.read.parquet(f"{sf}/part.parquet")
    assert not broadcasts(graph.containing(part, "p_name", part.selectExpr("p_brand AS term").distinct(), "term"))


def test_effects_broadcast_neither_names_nor_edges(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet").selectExpr("concat('p', p_partkey) AS drug", "p_name AS drug_name", "p_brand")
    edges = part.selectExpr("drug AS src", "p_brand AS dst", "'TARGETS' AS type")
    assert not broadcasts(graph.hop(part.select("drug"), edges, "TARGETS", "drug", "target"))
    few = graph.gathered(part.selectExpr("'all' AS k", "p_brand AS v"), ["k"], "v", "vs")
    # Values are made one before a key gathers them, each in two steps.
    assert plan(few).count("Aggregate(") == 4
    none = graph.gathered(part.selectExpr("'all' AS k", "CAST(NULL AS STRING) AS v"), ["k"], "v", "vs")
    assert few.collect()[0].vs == sorted({r.p_brand for r in part.collect()}) and none.collect()[0].vs == []


def test_names_query_broadcasts_nothing(spark, sf):
    assert not broadcasts(catalog.queries()["j08_names_containing"](spark, sf))


def test_metrics_broadcast_no_molecules(spark):
    rows = S.with_rings(S.molecules(spark.createDataFrame([(1, "Cc1ccccc1"), (2, "CC")], "molecule_id int, smiles string")))
    found = skeletons.subset_metrics(rows.selectExpr("molecule_id", "array(1, 2, 3, 4, 5, 6) atoms").where("molecule_id = 1"), rows)
    assert [(r.heavy_atoms, r.ring_count, r.has_benzene) for r in found.collect()] == [(6, 1, True)]
    few = S.with_rings(S.molecules(spark.range(3).selectExpr("id AS molecule_id", "'CC' AS smiles")))
    assert not broadcasts(skeletons.subset_metrics(few.selectExpr("molecule_id", "array(0) atoms"), few))
