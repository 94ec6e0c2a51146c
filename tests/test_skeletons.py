import pytest
from pyspark.sql import functions as F

from fragmill.functions import smiles as S
from fragmill.operators import skeletons
from fragmill.operators.skeletons import CUTS

TEXTS = [
    "CCCOCc1cc(c2ncccc2)ccc1", "CCCOCCC(=O)c1ccccc1", "CC(=O)NCCc1ccccc1", "CCN(CC)C(=O)CSC", "O=C1CCCN1CCC", "C1CCNCC1", "CCN1CCOCC1", "CC=CCC", "CCS(=O)(=O)NCC", "c1ccccc1N1CCCCC1", "CCOC(=O)CC", "c1ccn(CC)c1",
    "C1CCCCC1C1CCCCC1", "CC(C)(C)OC(=O)NCC", "CCCC", "c1ccc2ccccc2c1CC", "N#CCCN", "CCSSCC", "CC1OC1CC", "OCC",
]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame([(t, t) for t in [*TEXTS, "bad("]], "molecule_id string, smiles string").coalesce(1)
    return S.with_rings(S.molecules(df)).cache()


def brute_cuts(text: str) -> set:
    """The rules bond by bond, over plain lists of neighbours."""
    from fragmill.functions.rings import ring_bonds

    atoms, bonds = S.parsed(text)
    ring = ring_bonds([b[:2] for b in bonds])
    near = [[] for _ in atoms]
    for i, (a, b, kind, _) in enumerate(bonds):
        near[a].append((b, kind, i in ring))
        near[b].append((a, kind, i in ring))
    symbol = [label.lower() if aromatic else label for _, label, aromatic, *_ in atoms]

    def oxo(i):
        return any(k == "=" and symbol[j] == "O" for j, k, _ in near[i])

    def of(i):
        s, out, degree, here = symbol[i], set(), len(near[i]), near[i]
        ringed = any(r for *_, r in here)
        free = [symbol[j].upper() for j, k, r in here if k == "-" and not r]
        inner = [symbol[j] for j, k, r in here if k == "-" and r]
        around = [symbol[j] for j, k, _ in here if k == ":"]
        lactam = any(r and symbol[j] == "C" and oxo(j) for j, k, r in here)
        if s == "C":
            if degree == 3 and oxo(i) and sum(symbol[j].upper() in "CNO" for j, *_ in here) >= 2:
                out.add(1)
            if degree > 1 and all(k != "=" for _, k, _ in here) and "C" in free:
                out.add(4)
            if degree == 3 and not ringed and oxo(i) and set(free) & {"C", "N", "O"}:
                out.add(6)
            if degree in (2, 3) and any(k == "-" and symbol[j].upper() == "C" for j, k, _ in here):
                out.add(7)
            if degree > 1 and not ringed and all(k == "-" for _, k, _ in here):
                out.add(8)
            if any(x in "NOS" for x in inner) and sum(x in "CNOS" for x in inner) >= 2:
                out.add(13)
            if inner.count("C") >= 2:
                out.add(15)
        if s == "O" and degree == 2 and "C" in free:
            out.add(3)
        if s == "N":
            if degree > 1 and all(k != "=" for _, k, _ in here) and all(symbol[j].upper() in "CS" for j, k, _ in here if k == "-") and not lactam:
                out.add(5)
            if lactam and sum(x in "CNOS" for x in inner) >= 2:
                out.add(10)
        if s == "S" and degree == 2 and "C" in free:
            out.add(11)
        if s == "S" and degree == 4 and sum(k == "=" and symbol[j] == "O" for j, k, _ in here) == 2 and any(symbol[j].upper() == "C" for j, *_ in here):
            out.add(12)
        if s == "n" and atoms[i][3] == 0 and sum(x in "cnos" for x in around) >= 2:
            out.add(9)
        if s == "c":
            if any(x in "nos" for x in around) and sum(x in "cnos" for x in around) >= 2:
                out.add(14)
            if around.count("c") >= 2:
                out.add(16)
        return out

    sets = [of(i) for i in range(len(atoms))]
    found = set()
    for i, (a, b, kind, _) in enumerate(bonds):
        for x in sets[a]:
            for y in sets[b]:
                if i not in ring and ((x, y) in CUTS or (y, x) in CUTS) and kind == ("=" if x == y == 7 else "-"):
                    found.add((a, b))
    return found


def test_cuts_equal_brute_force(rows):
    found = {t: set() for t in TEXTS}
    for r in skeletons.cuts(rows).collect():
        found[r.molecule_id].add((r.a, r.b))
    assert found == {t: brute_cuts(t) for t in TEXTS}
    assert found["CCCOCc1cc(c2ncccc2)ccc1"] == {(2, 3), (3, 4), (4, 5), (7, 8)}
    parts = {}
    for r in skeletons.cut_parts(rows).collect():
        parts.setdefault(r.molecule_id, []).append(r.atoms)
    assert sorted(parts["CCCOCc1cc(c2ncccc2)ccc1"]) == [[0, 1, 2], [3], [4], [5, 6, 7, 14, 15, 16], [8, 9, 10, 11, 12, 13]]
    assert "CCCC" not in parts and "bad(" not in parts


def test_scaffolds(spark):
    want = {"CCc1ccccc1": [2, 3, 4, 5, 6, 7], "O=C1CCCCC1CC": [0, 1, 2, 3, 4, 5, 6], "c1ccccc1CCc1ccccc1C": list(range(14)), "CC(CC1CC1)C=C": [3, 4, 5], "C1CC1CC(=O)CC1CC1": list(range(10))}
    df = spark.createDataFrame([(t, t) for t in [*want, "CCCC", "bad("]], "molecule_id string, smiles string")
    found = {r.molecule_id: r.atoms for r in skeletons.scaffold(S.with_rings(S.molecules(df))).collect()}
    assert found == want


def test_residues(spark):
    df = spark.createDataFrame([("dipeptide", "NCC(=O)N1CCCC1C(=O)O"), ("ester", "CC(N)C(=O)OCC"), ("none", "CCN"), ("bad", "C("), ("null", None)], "molecule_id string, smiles string")
    found = sorted((r.molecule_id, r.alpha, r.name, r.atoms, r.side_chain) for r in skeletons.residues(S.with_rings(S.molecules(df))).collect())
    assert found == [
        ("dipeptide", 1, "glycine", [0, 1, 2, 3], []),
        ("dipeptide", 8, "proline", [4, 5, 6, 7, 8, 9, 10, 11], [5, 6, 7]),
        ("ester", 1, "amino_acid_like", [0, 1, 2, 3, 4, 5], [0]),
    ]


def test_largest_part(spark):
    texts = ["[Na+].CC(=O)[O-]", "CC.CO", "", None, "x(.CCC", "  CCO.C  ", "[H][H]"]
    df = spark.createDataFrame([(t,) for t in texts], "smiles string")
    assert [r[0] for r in df.select(S.largest_part(F.col("smiles"))).collect()] == ["CC(=O)[O-]", "CC", None, None, "CCC", "CCO", None]
