import random
from itertools import combinations

import pytest

from fragmill.functions import smiles as S
from fragmill.functions.rings import ring_bonds, smallest_rings


def brute_cycles(bonds):
    """Every simple cycle as a set of bonds, by trying all sets."""
    out = []
    for size in range(3, len(bonds) + 1):
        for chosen in combinations(range(len(bonds)), size):
            degree, parent = {}, {}

            def find(a, parent=parent):
                while parent.setdefault(a, a) != a:
                    a = parent[a]
                return a

            joins = 0
            for i in chosen:
                a, b = bonds[i]
                degree[a], degree[b] = degree.get(a, 0) + 1, degree.get(b, 0) + 1
                if find(a) != find(b):
                    parent[find(a)] = find(b)
                    joins += 1
            if set(degree.values()) == {2} and joins == size - 1:
                out.append(set(chosen))
    return out


def rank(masks):
    kept = {}
    for mask in masks:
        while mask and mask.bit_length() in kept:
            mask ^= kept[mask.bit_length()]
        if mask:
            kept[mask.bit_length()] = mask
    return len(kept)


@pytest.mark.parametrize("seed", range(40))
def test_rings_are_a_smallest_basis(seed):
    rng = random.Random(seed)
    n = rng.randint(3, 8)
    bonds = sorted(rng.sample([(a, b) for a in range(n) for b in range(a)], rng.randint(2, min(11, n * (n - 1) // 2))))
    cycles, rings = brute_cycles(bonds), [set(r) for r in smallest_rings(bonds)]
    assert all(r in cycles for r in rings)
    mask = lambda r: sum(1 << i for i in r)
    assert rank(map(mask, rings)) == len(rings) == rank(map(mask, cycles))
    total, found = 0, []
    for cycle in sorted(cycles, key=len):
        if rank([*found, mask(cycle)]) > len(found):
            found.append(mask(cycle))
            total += len(cycle)
    assert sum(map(len, rings)) == total
    assert ring_bonds(bonds) == set().union(*cycles, set())


FEATURES = {
    # heavy atoms, rings, aromatic rings, hetero atoms, bonds in no ring, rotatable, branches, benzene
    "c1ccc2ccccc2c1": (10, 2, 2, 0, 0, 0, 2, True),
    "c1ccccc1c1ccccc1": (12, 2, 2, 0, 1, 1, 2, True),
    "C1CCCCC1": (6, 1, 0, 0, 0, 0, 0, False),
    "CCCC": (4, 0, 0, 0, 3, 1, 0, False),
    "CC(C)(C)CC": (6, 0, 0, 0, 5, 0, 2, False),
    "CCC(=O)NCC": (7, 0, 0, 2, 6, 2, 1, False),
    "CCC#CCC": (6, 0, 0, 0, 5, 0, 0, False),
    "C12C3C4C1C5C2C3C45": (8, 5, 0, 0, 0, 0, 8, False),
    "c1ccc2c(c1)Cc1ccccc12": (13, 3, 2, 0, 0, 0, 4, True),
    "FC(F)(F)CO": (6, 0, 0, 4, 5, 0, 2, False),
    "c1ccsc1": (5, 1, 1, 1, 0, 0, 0, False),
}


def test_features(spark):
    df = spark.createDataFrame([(s, s) for s in [*FEATURES, "bad("]], "molecule_id string, smiles string")
    rows = S.features(S.with_rings(S.molecules(df))).collect()
    names = ["heavy_atoms", "rings", "aromatic_rings", "hetero_atoms", "nonring_bonds", "rotatable_bonds", "branches", "has_benzene"]
    found = {r["molecule_id"]: tuple(r[n] for n in names) for r in rows}
    assert {s: found[s] for s in FEATURES} == FEATURES
    assert found["bad("][0] is None
    score = {r["molecule_id"]: r["score"] for r in rows}["CCC(=O)NCC"]
    assert score == pytest.approx(0.23 * 6 + 0.13 * 2 + 0.06 + 0.04 * 7 + 0.02 * 2)


@pytest.mark.parametrize(
    ("text", "hydrogens", "charges"),
    [("CC(=O)O", [3, 0, 0, 1], [0] * 4), ("c1cc[nH]c1", [1, 1, 1, 1, 1], [0] * 5), ("c1ccncc1", [1, 1, 1, 0, 1, 1], [0] * 6), ("C[N+](=O)[O-]", [3, 0, 0, 0], [0, 1, 0, -1]),
     ("[NH4+]", [4], [1]), ("[Fe++]", [0], [2]), ("[O-2]", [0], [-2]), ("CS(=O)(=O)C", [3, 0, 0, 0, 3], [0] * 5), ("c1ccc2ccccc2c1", [1, 1, 1, 0, 1, 1, 1, 1, 0, 1], [0] * 10), ("N[C@@H](C)C(=O)O", [2, 1, 3, 0, 0, 1], [0] * 6), ("[H]O[H]", [2], [0]), ("c1ccsc1", [1, 1, 1, 0, 1], [0] * 5), ("Cn1cccc1", [3, 0, 1, 1, 1, 1], [0] * 6)],
)
def test_hydrogens_and_charges(text, hydrogens, charges):
    atoms, _ = S.parsed(text)
    assert [a[4] for a in atoms] == hydrogens and [a[3] for a in atoms] == charges


def test_an_unsigned_bond_between_two_aromatic_rings_is_single():
    for text in ("c1ccccc1c1ccccc1", "c1ccccc1-c1ccccc1"):
        bonds = S.parsed(text)[1]
        assert [b[2] for b in bonds].count(":") == 12 and len({b[3] for b in bonds} - {None}) == 2
