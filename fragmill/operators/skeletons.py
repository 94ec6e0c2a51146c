"""Scaffolds, residues, cuts by rules and parts of molecules, each told from a molecule's own arrays: nothing is shuffled.

rows have molecule_id, molecule and rings as functions.smiles gives them. A null
molecule gives no rows, or a null where a function gives a row for each molecule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fragmill.operators.fragments import part_of

ATOMS, BONDS = "molecule.atoms", "molecule.bonds"


def with_near(rows: DataFrame) -> DataFrame:
    """rows with near: for each atom its neighbours in the order of bonds, (atom, kind, ring), ring if the bond lies in one."""
    within = F.array_distinct(F.flatten(F.transform("rings", lambda r: r["bonds"])))
    bonds = F.transform(BONDS, lambda x, i: F.struct(x["a"].alias("a"), x["b"].alias("b"), x["kind"].alias("kind"), F.array_contains("_within", i).alias("ring")))
    rows = rows.withColumn("_within", within).withColumn("_bonds", bonds)
    at = lambda a: F.filter("_bonds", lambda x: (x["a"] == a) | (x["b"] == a))
    other = lambda x, a: F.struct(F.when(x["a"] == a, x["b"]).otherwise(x["a"]).alias("atom"), x["kind"].alias("kind"), x["ring"].alias("ring"))
    return rows.withColumn("near", F.transform(ATOMS, lambda x: F.transform(at(x["atom"]), lambda y: other(y, x["atom"])))).drop("_within", "_bonds")


def _numbers(of: str | Column) -> Column:
    return F.transform(of, lambda x: x["atom"])


def scaffold(rows: DataFrame) -> DataFrame:
    """(molecule_id, atoms): rings and what links them, with the atoms that double bonds hold to these; no row without a ring.

    Bonds with an end of one bond are taken off until none is left, in as many
    rounds as the molecule has bonds at most.
    """
    degree = lambda bonds, a: F.size(F.filter(bonds, lambda y: (y["a"] == a) | (y["b"] == a)))
    pairs = F.transform(BONDS, lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b")))
    peeled = lambda bonds, _: F.filter(bonds, lambda x: (degree(bonds, x["a"]) > 1) & (degree(bonds, x["b"]) > 1))
    rounds = F.sequence(F.lit(1), F.size(BONDS))
    rows = rows.where(F.size("rings") > 0).select("molecule_id", BONDS, F.aggregate(rounds, pairs, peeled).alias("_left"))
    core = F.array_distinct(F.flatten(F.transform("_left", lambda x: F.array(x["a"], x["b"]))))
    rows = rows.withColumn("_core", core)
    doubly = F.filter("bonds", lambda x: (x["kind"] == "=") & (F.array_contains("_core", x["a"]) | F.array_contains("_core", x["b"])))
    beside = F.flatten(F.transform(doubly, lambda x: F.array(x["a"], x["b"])))
    return rows.select("molecule_id", F.array_sort(F.array_union("_core", beside)).alias("atoms"))


def residues(rows: DataFrame) -> DataFrame:
    """(molecule_id, alpha, name, class, atoms, side_chain) of each amino acid residue.

    An alpha carbon is a carbon in no aromatic ring with a nitrogen and a carbon
    that has a double bond to an oxygen; of several the first by bond counts. Side
    chain are the atoms reached from its other neighbours without going through
    it, these two and the oxygens beside. One that comes back to the nitrogen makes
    proline, one without atoms glycine; all others are amino_acid_like, as the
    templates of the known ones carry a mark of attachment that no side chain has.
    """
    near = with_near(rows.where("molecule is not null").where(F.col(ATOMS).isNotNull()))
    label = lambda a: F.get(ATOMS, a)["label"]
    of = lambda a: F.get("near", a)
    carbonyl = lambda a: (label(a) == "C") & F.exists(of(a), lambda y: (y["kind"] == "=") & (label(y["atom"]) == "O"))
    first = lambda a, test: F.get(_numbers(F.filter(of(a), lambda y: test(y["atom"]))), 0)
    alphas = F.transform(
        F.filter(ATOMS, lambda x: (x["label"] == "C") & ~x["aromatic"]),
        lambda x: F.struct(x["atom"].alias("alpha"), first(x["atom"], lambda a: label(a) == "N").alias("n"), first(x["atom"], carbonyl).alias("c")),
    )
    each = near.withColumn("_x", F.explode(F.filter(alphas, lambda x: x["n"].isNotNull() & x["c"].isNotNull()))).select("molecule_id", "molecule", "near", "_x.*")
    oxygens = _numbers(F.filter(of(F.col("c")), lambda y: label(y["atom"]) == "O"))
    each = each.withColumn("_blocked", F.array_union(F.array("alpha", "n", "c"), oxygens))
    spread = lambda seen, _: F.array_except(F.array_union(seen, F.flatten(F.transform(seen, lambda a: _numbers(of(a))))), "_blocked")
    side = F.aggregate(F.sequence(F.lit(1), F.size(ATOMS)), F.array_except(_numbers(of(F.col("alpha"))), "_blocked"), spread)
    each = each.withColumn("_side", side)
    closes = F.arrays_overlap(_numbers(of(F.col("n"))), "_side")
    name = F.when(closes, "proline").when(F.size("_side") == 0, "glycine").otherwise("amino_acid_like")
    kind = F.when(closes, "hydrophobic").when(F.size("_side") == 0, "special").otherwise("unclassified")
    return each.select("molecule_id", "alpha", name.alias("name"), kind.alias("class"), F.array_sort(F.array_union("_blocked", "_side")).alias("atoms"), F.array_sort("_side").alias("side_chain"))


#: Which surroundings of a bond's ends (by number, see surroundings) let it be cut, all in no ring; 7 and 7 is a double bond.
CUTS = (
    (1, 3), (1, 5), (1, 10), (3, 4), (3, 13), (3, 14), (3, 15), (3, 16), (4, 5), (4, 11), (5, 12), (5, 13), (5, 14), (5, 15), (5, 16), (6, 13), (6, 14), (6, 15), (6, 16), (7, 7),
    (8, 9), (8, 10), (8, 13), (8, 14), (8, 15), (8, 16), (9, 13), (9, 14), (9, 15), (9, 16), (10, 13), (10, 14), (10, 15), (10, 16), (11, 13), (11, 14), (11, 15), (11, 16),
    (13, 14), (13, 15), (13, 16), (14, 14), (14, 15), (14, 16), (15, 16), (16, 16),
)


def surroundings(rows: DataFrame) -> DataFrame:
    """rows with near and around: for each atom the numbers of the retrosynthetic surroundings that it stands in."""
    rows = with_near(rows)
    label, aromatic = lambda a: F.get(ATOMS, a)["label"], lambda a: F.get(ATOMS, a)["aromatic"]
    of = lambda a: F.get("near", a)
    some = lambda a, test: F.exists(of(a), test)
    many = lambda a, test: F.size(F.filter(of(a), test))
    ringed = lambda a: some(a, lambda y: y["ring"])

    def numbers(x: Column) -> Column:
        a, degree = x["atom"], F.size(of(x["atom"]))
        plain, carbon, nitrogen = ~x["aromatic"], x["label"] == "C", x["label"] == "N"
        oxo = some(a, lambda y: (y["kind"] == "=") & (label(y["atom"]) == "O"))
        double = some(a, lambda y: y["kind"] == "=")
        free = lambda *labels: some(a, lambda y: ~y["ring"] & (y["kind"] == "-") & label(y["atom"]).isin(*labels))
        lactam = lambda y: y["ring"] & (label(y["atom"]) == "C") & ~aromatic(y["atom"]) & some(y["atom"], lambda z: (z["kind"] == "=") & (label(z["atom"]) == "O"))
        in_ring = lambda *labels: many(a, lambda y: y["ring"] & (y["kind"] == "-") & label(y["atom"]).isin(*labels) & ~aromatic(y["atom"]))
        beside = lambda *labels: many(a, lambda y: (y["kind"] == ":") & label(y["atom"]).isin(*labels))
        tests = {
            1: plain & carbon & (degree == 3) & oxo & (many(a, lambda y: label(y["atom"]).isin("C", "N", "O")) >= 2),
            3: plain & (x["label"] == "O") & (degree == 2) & free("C"),
            4: plain & carbon & (degree > 1) & ~double & free("C"),
            5: plain & nitrogen & (degree > 1) & ~double & ~some(a, lambda y: (y["kind"] == "-") & ~label(y["atom"]).isin("C", "S")) & ~some(a, lactam),
            6: plain & carbon & (degree == 3) & ~ringed(a) & oxo & free("C", "N", "O"),
            7: plain & carbon & degree.isin(2, 3) & some(a, lambda y: (y["kind"] == "-") & (label(y["atom"]) == "C")),
            8: plain & carbon & (degree > 1) & ~ringed(a) & ~some(a, lambda y: y["kind"] != "-"),
            9: x["aromatic"] & nitrogen & (x["charge"] == 0) & (beside("C", "N", "O", "S") >= 2),
            10: plain & nitrogen & some(a, lactam) & (in_ring("C", "N", "O", "S") >= 2),
            11: plain & (x["label"] == "S") & (degree == 2) & free("C"),
            12: plain & (x["label"] == "S") & (degree == 4) & (many(a, lambda y: (y["kind"] == "=") & (label(y["atom"]) == "O")) >= 2) & some(a, lambda y: label(y["atom"]) == "C"),
            13: plain & carbon & (in_ring("N", "O", "S") >= 1) & (in_ring("C", "N", "O", "S") >= 2),
            14: x["aromatic"] & carbon & (beside("N", "O", "S") >= 1) & (beside("C", "N", "O", "S") >= 2),
            15: plain & carbon & (in_ring("C") >= 2),
            16: x["aromatic"] & carbon & (beside("C") >= 2),
        }
        return F.array_compact(F.array(*(F.when(test, number) for number, test in tests.items())))

    return rows.withColumn("around", F.transform(ATOMS, numbers))


def cuts(rows: DataFrame) -> DataFrame:
    """(molecule_id, a, b) of each bond that the rules cut: in no ring, single (double for 7 and 7), its ends in two surroundings that a rule names."""
    rules = F.array(*(F.array(F.lit(x), F.lit(y)) for x, y in {*CUTS, *((y, x) for x, y in CUTS)}))
    each = surroundings(rows).select("molecule_id", "around", F.explode(F.flatten(F.transform("near", lambda n, i: F.transform(n, lambda y: F.struct(i.alias("a"), y["atom"].alias("b"), y["kind"].alias("kind"), y["ring"].alias("ring")))))).alias("x"))
    each = each.where("x.a < x.b and not x.ring").select("molecule_id", "x.a", "x.b", "x.kind", F.get("around", F.col("x.a")).alias("_left"), F.get("around", F.col("x.b")).alias("_right"))
    double = F.lit(7)
    named = F.exists(rules, lambda r: (r[0] != double) & F.array_contains("_left", r[0]) & F.array_contains("_right", r[1]))
    both = F.array_contains("_left", double) & F.array_contains("_right", double)
    return each.where(((F.col("kind") == "-") & named) | ((F.col("kind") == "=") & both)).select("molecule_id", "a", "b")


def cut_parts(rows: DataFrame) -> DataFrame:
    """(molecule_id, atoms) of the parts that are left without the bonds that the rules cut; none where none is cut."""
    gone = cuts(rows).groupBy("molecule_id").agg(F.collect_set(F.struct("a", "b")).alias("_gone"))
    kept = F.filter(F.transform(BONDS, lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"))), lambda x: ~F.array_contains("_gone", x))
    each = rows.join(gone.hint("merge"), "molecule_id").select("molecule_id", F.explode(F.arrays_zip(part_of(_numbers(ATOMS), kept).alias("part"), _numbers(ATOMS).alias("atom"))).alias("x"))
    return each.groupBy("molecule_id", "x.part").agg(F.array_sort(F.collect_list("x.atom")).alias("atoms")).drop("part")


def subset_metrics(subsets: DataFrame, rows: DataFrame) -> DataFrame:
    """subsets (molecule_id, atoms) with heavy_atoms, ring_count, aromatic_ring_count and has_benzene of the rings that lie in them whole. Molecules are not broadcast."""
    each = subsets.join(rows.select("molecule_id", "molecule", "rings").hint("merge"), "molecule_id")
    whole = F.filter("rings", lambda r: F.size(F.array_except(r["atoms"], "atoms")) == 0)
    aromatic = F.filter(whole, lambda r: F.forall(r["atoms"], lambda a: F.get(ATOMS, a)["aromatic"]))
    return each.select(*subsets.columns, F.size("atoms").alias("heavy_atoms"), F.size(whole).alias("ring_count"), F.size(aromatic).alias("aromatic_ring_count"), F.exists(aromatic, lambda r: F.size(r["atoms"]) == 6).alias("has_benzene"))
