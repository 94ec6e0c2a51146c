from fragmill.functions import smiles as S
from fragmill.operators.split import semantic_split


def test_kinds_that_are_kept(spark):
    texts = {"anilide": "CC(=O)Nc1ccccc1", "glycylglycine": "NCC(=O)NCC(=O)O", "butane": "CCCC", "pentane": "CCCCC", "bad": "C("}
    df = spark.createDataFrame(list(texts.items()), "molecule_id string, smiles string")
    rows = semantic_split(S.with_rings(S.molecules(df)), (3, 4)).collect()
    found = {m: {(r.semantic_type, r.smiles) for r in rows if r.molecule_id == m} for m in texts}
    assert {t for t, _ in found["glycylglycine"]} == {"amino_acid_residue"} and len(found["glycylglycine"]) == 2
    assert found["bad"] == found["butane"] == set() and {t for t, _ in found["pentane"]} == {"connected_component"}
    kinds = {r.semantic_type: r for r in rows if r.molecule_id == "anilide"}
    assert set(kinds) == {"murcko_scaffold", "functional_group", "brics", "path"}
    assert kinds["murcko_scaffold"].has_benzene and kinds["murcko_scaffold"].heavy_atoms == 6
    groups = {r.label: r for r in rows if r.molecule_id == "anilide" and r.semantic_type == "functional_group"}
    assert set(groups) == {"amide"} and groups["amide"].stop_decompose and groups["amide"].stop_reason == "high_semantic_functional_group"
    texts_of = [r.smiles for r in rows if r.molecule_id == "anilide"]
    assert len(texts_of) == len(set(texts_of))
