import pytest

from fragmill.functions import smiles as S
from fragmill.operators import fragments, matching

MOLECULES = {
    "cyclohexane": "C1CCCCC1",
    "benzene": "c1ccccc1",
    "naphthalene": "c1ccc2ccccc2c1",
    "phenethylamine": "NCCc1ccccc1",
    "ethoxybenzene": "CCOc1ccccc1",
    "ether": "CCOCC",
    "salt": "[Na+].[Cl-]",
    "biphenyl": "c1ccccc1-c1ccccc1",
}


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame(list(MOLECULES.items()), "molecule_id string, smiles string").coalesce(1)
    return S.molecules(df).cache()


def test_closed_states(rows):
    bonds = S.bonds_of(rows)
    units, systems = S.units_of(bonds)
    found = fragments.enumerated(units, 20, systems)
    counts = {r.molecule_id: r["count"] for r in found.groupBy("molecule_id").count().collect()}
    want = {"cyclohexane": 31, "benzene": 1, "naphthalene": 1, "phenethylamine": 7, "ethoxybenzene": 7, "ether": 10, "biphenyl": 3}
    assert counts == want
    atoms = {r.molecule_id: r.n for r in found.selectExpr("molecule_id", "size(atoms) n").groupBy("molecule_id").agg({"n": "max"}).withColumnRenamed("max(n)", "n").collect()}
    assert atoms["naphthalene"] == 10 and atoms["benzene"] == 6


def test_mirrored_fragments_have_one_signature(rows):
    ether = rows.where("molecule_id = 'ether'")
    units, systems = S.units_of(S.bonds_of(ether))
    found = fragments.enumerated(units, 4, systems)
    got = matching.signatures(found, S.atoms_of(ether), S.bonds_of(ether), 3)
    four = [r.signature for r in got.where("size(atoms) = 4").collect()]
    assert len(four) == 2 and len(set(four)) == 1
    assert got.select("signature").distinct().count() == 5  # CC, CO, CCO, COC, CCOC


def test_metrics(rows):
    got = {r.molecule_id: r for r in S.metrics(rows).collect()}
    assert (got["naphthalene"].rings, got["naphthalene"].aromatic_atoms, got["naphthalene"].formula) == (2, 10, "C10")
    assert (got["phenethylamine"].heavy_atoms, got["phenethylamine"].hetero_atoms, got["phenethylamine"].formula) == (9, 1, "C8N")


def test_substructures(rows):
    atoms, bonds = S.atoms_of(rows), S.bonds_of(rows)
    cco = matching.Pattern(("C", "C", "O"), ((0, 1), (1, 2)))
    hits = lambda p: {r.molecule_id for r in matching.disjoint(p, atoms, bonds).collect()}
    assert hits([cco]) == {"ethoxybenzene", "ether"}
    assert hits([cco, cco]) == set()
    assert hits([cco, matching.Pattern(("C", "C"), ((0, 1),))]) == {"ethoxybenzene", "ether"}
    ring = matching.Pattern(("C",) * 6, tuple((i, (i + 1) % 6) for i in range(6)))
    assert hits([ring]) == {"cyclohexane", "benzene", "naphthalene", "phenethylamine", "ethoxybenzene", "biphenyl"}
    assert hits([ring, ring]) == {"biphenyl"}
    with pytest.raises(ValueError):
        matching.Pattern(("C", "C")).ordered()


@pytest.mark.parametrize("text", [None, "", "C(", "C1CC", "C)", "xyz", "1CC"])
def test_what_is_no_smiles(text):
    assert S.parsed(text) is None


def test_hydrogens_and_brackets():
    atoms, bonds = S.parsed("[H]C([2H])=[13CH2].[NH4+]")
    assert [a[1] for a in atoms] == ["C", "C", "N"] and bonds == [(0, 1, "=", None)]
