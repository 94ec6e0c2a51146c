from itertools import permutations

import pytest

from fragmill.functions import smiles as S
from fragmill.operators.patterns import FUNCTIONAL_GROUPS, Atom, Structure, holding, matches

TEXTS = [
    "CCO", "OC(=O)CN", "CC(=O)[O-]", "CC(=O)NC", "CNC", "c1ccccc1O", "COC", "CSC", "c1ccsc1", "N#CCC#N", "C[N+](=O)[O-]", "NC(=O)N", "CN(C)C(C)=O", "c1cc[nH]c1", "[NH4+]", "OCC(O)CO",
    "CCOCC", "CC(=O)OCC", "O=C1CCCN1", "C1CCNCC1", "c1ccc2ccccc2c1", "C", "O", "CC.OC",
]


def brute(s: Structure, atoms: list, bonds: list) -> set:
    """By trying all choices of atoms."""
    kinds = {(a, b): k for a, b, k, _ in bonds} | {(b, a): k for a, b, k, _ in bonds}
    degree = [sum(i in x[:2] for x in bonds) for i in range(len(atoms))]

    def passes(i, tests):
        _, label, aromatic, charge, hydrogens = atoms[i]
        return any(
            label in t.labels and t.aromatic in (None, aromatic) and t.charge in (None, charge) and (not t.hydrogens or hydrogens in t.hydrogens)
            and t.connections in (None, degree[i] + hydrogens) for t in tests
        )

    found = set()
    for chosen in permutations(range(len(atoms)), len(s.atoms)):
        if all(map(passes, chosen, s.atoms)) and all((chosen[i], chosen[j]) in kinds and (not k or kinds[chosen[i], chosen[j]] in k) for i, j, k in s.bonds):
            if not any(chosen[p] in {m[0] for m in brute_ordered(o, atoms, bonds)} for p, o in s.without):
                found.add(tuple(sorted(chosen)))
    return found


def brute_ordered(s, atoms, bonds):
    kinds = {(a, b): k for a, b, k, _ in bonds} | {(b, a): k for a, b, k, _ in bonds}
    for chosen in permutations(range(len(atoms)), len(s.atoms)):
        if all(any(atoms[i][1] in t.labels and t.aromatic in (None, atoms[i][2]) for t in tests) for i, tests in zip(chosen, s.atoms)):
            if all((chosen[i], chosen[j]) in kinds and kinds[chosen[i], chosen[j]] in k for i, j, k in s.bonds):
                yield chosen


@pytest.fixture(scope="module")
def tables(spark):
    rows = S.molecules(spark.createDataFrame([(t, t) for t in TEXTS], "molecule_id string, smiles string").coalesce(1)).cache()
    return S.atoms_of(rows), S.bonds_of(rows)


def test_groups_and_drawn_structures_equal_brute_force(tables):
    drawn = [Structure.of_smiles(t) for t in ("CC", "CO", "C=O", "c1ccccc1", "CCO", "OCCO", "[O-]", "C1CCNCC1", "NC=O", "C")]
    found = {}
    for r in matches([*FUNCTIONAL_GROUPS, *drawn], *tables).collect():
        key = (r["name"], r["molecule_id"])
        assert tuple(sorted(r["atoms"])) not in found.setdefault(key, set())
        found[key].add(tuple(sorted(r["atoms"])))
    for s in [*FUNCTIONAL_GROUPS, *drawn]:
        for t in TEXTS:
            atoms, bonds = S.parsed(t)
            if len(atoms) <= 8 or len(s.atoms) <= 3:
                assert found.get((s.name, t), set()) == brute(s, atoms, bonds), (s.name, t)


def test_searches(tables):
    searches = {"two ends": ["CO", "CO"], "ester": ["CC(=O)OCC"], "mixed": ["N#C", "N#C"], "ring": ["C1CCNCC1"], "none": ["CCO", "CCO", "CCO"], "parts": ["CC", "OC"]}
    found = {}
    for r in holding(searches, *tables).collect():
        found.setdefault(r["search"], set()).add(r["molecule_id"])
    assert found["mixed"] == {"N#CCC#N"} and found["ring"] == {"C1CCNCC1"} and found["ester"] == {"CC(=O)OCC"}
    assert found["two ends"] == {"OCC(O)CO", "CCOCC", "CC(=O)OCC"} - {"CCOCC"} - {"CC(=O)OCC"}
    assert "none" not in found and "CC.OC" in found["parts"]
    for bad in ({"x": []}, {"x": ["C("]}):
        with pytest.raises(ValueError):
            holding(bad, *tables)


def test_plan_is_as_large_for_many_structures(tables):
    lines = lambda n: len(matches([Structure(f"s{i}", ((Atom(("C",)),), (Atom(("O", f"X{i}")),)), ((0, 1, ()),)) for i in range(n)], *tables)._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert lines(1000) == lines(10)


def test_structures_that_hang_apart_are_refused():
    with pytest.raises(ValueError, match="connected"):
        Structure.of_smiles("C.C").steps()
