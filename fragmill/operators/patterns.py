"""Many structures looked for in many molecules at once: their steps are rows of one prefix tree that a single plan walks."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fragmill.functions.smiles import parsed
from fragmill.session import settled


@dataclass(frozen=True)
class Atom:
    """What an atom must be; what is not given may be anything."""

    labels: tuple[str, ...]
    aromatic: bool | None = None
    charge: int | None = None
    hydrogens: tuple[int, ...] = ()
    #: Neighbours and hydrogens together.
    connections: int | None = None


@dataclass(frozen=True)
class Structure:
    """Atoms, each with the tests of which it must pass one, and bonds (i, j, kinds); no kinds allow any.

    without names other structures, each with the place whose atom must not be the
    first atom of a match of it.
    """

    name: str
    atoms: tuple[tuple[Atom, ...], ...]
    bonds: tuple[tuple[int, int, tuple[str, ...]], ...] = ()
    without: tuple[tuple[int, Structure], ...] = ()

    @classmethod
    def of_smiles(cls, text: str, name: str | None = None) -> Structure:
        """The structure that a SMILES text draws: elements, charges that are not zero, and kinds of bonds count."""
        found = parsed(text)
        if found is None:
            raise ValueError(f"no SMILES: {text!r}")
        atoms, bonds = found
        return cls(text if name is None else name, tuple((Atom((x[1],), charge=x[3] or None),) for x in atoms), tuple((a, b, (k,)) for a, b, k, _ in bonds))

    def steps(self) -> tuple[list[tuple], list[int]]:
        """The ways from atom to atom, each (place it begins at, place it closes on or None, kinds, tests), and the place of each atom."""
        places, steps, left = {0: 0}, [(None, None, (), self.atoms[0])], list(self.bonds)
        while left:
            bond = next((b for b in left if b[0] in places and b[1] in places), None) or next((b for b in left if b[0] in places or b[1] in places), None)
            if bond is None:
                break
            left.remove(bond)
            i, j, kinds = bond if bond[0] in places else (bond[1], bond[0], bond[2])
            if j in places:
                steps.append((places[i], places[j], kinds, ()))
            else:
                places[j] = len(places)
                steps.append((places[i], None, kinds, self.atoms[j]))
        if left or len(places) < len(self.atoms):
            raise ValueError(f"{self.name} is not connected")
        return steps, [places[k] for k in range(len(self.atoms))]


def _one(*labels: str, **test) -> tuple[Atom, ...]:
    return (Atom(labels, **test),)


_ACYL = Structure("N of an amide", (_one("N", aromatic=False), _one("C", aromatic=False), _one("O", aromatic=False)), ((0, 1, ("-",)), (1, 2, ("=",))))
#: The eight functional groups, by name.
FUNCTIONAL_GROUPS = (
    Structure("hydroxyl", (_one("O", aromatic=False, connections=2, hydrogens=(1,)),)),
    Structure("carboxyl", (_one("C", aromatic=False, connections=3), _one("O", aromatic=False), (Atom(("O",), False, None, (1,), 2), Atom(("O",), False, -1))), ((0, 1, ("=",)), (0, 2, ("-",)))),
    Structure("amide", (_one("C", aromatic=False, connections=3), _one("O", aromatic=False), _one("N", aromatic=False, connections=3)), ((0, 1, ("=",)), (0, 2, ("-",)))),
    Structure("amine", (_one("N", aromatic=False, connections=3, hydrogens=(0, 1, 2)),), without=((0, _ACYL),)),
    Structure("ether", (_one("C"), _one("O", aromatic=False), _one("C")), ((0, 1, ("-",)), (1, 2, ("-",)))),
    Structure("thioether", (_one("C"), _one("S", aromatic=False), _one("C")), ((0, 1, ("-",)), (1, 2, ("-",)))),
    Structure("nitrile", (_one("C", aromatic=False), _one("N", aromatic=False)), ((0, 1, ("#",)),)),
    Structure("nitro", (_one("N", aromatic=False, charge=1), _one("O", aromatic=False), _one("O", aromatic=False, charge=-1)), ((0, 1, ("=",)), (0, 2, ("-",)))),
)

_STEP = """node int, parent int, depth int, at int, closes int, kinds array<string>,
    tests array<struct<labels: array<string>, aromatic: boolean, charge: int, hydrogens: array<int>, connections: int>>"""
_STAYS = "."


def _tree(structures: list[Structure]) -> tuple[list[tuple], list[tuple]]:
    """Rows of steps, and (node, name, places) of where structures end; all end at one depth, the shorter ones by staying where they are."""
    rows, ends, known = [], [], {}
    ways = [(s, *s.steps()) for s in structures]
    depth = max(len(steps) for _, steps, _ in ways)
    for s, steps, places in ways:
        node = 0
        for d, step in enumerate(steps + [(0, None, (_STAYS,), ())] * (depth - len(steps))):
            if (node, step) not in known:
                known[node, step] = len(rows) + 1
                tests = [(list(t.labels), t.aromatic, t.charge, list(t.hydrogens), t.connections) for t in step[3]]
                rows.append((len(rows) + 1, node, d, step[0], step[1], list(step[2]), tests))
            node = known[node, step]
        ends.append((node, s.name, places))
    return rows, ends


def _passes(labels, aromatic, charge, hydrogens, connections):
    """Whether an atom passes one of the tests of its step; a step without tests lets all pass."""
    return (F.size("tests") == 0) | F.exists(
        "tests",
        lambda t: F.array_contains(t["labels"], labels)
        & (t["aromatic"].isNull() | (t["aromatic"] == aromatic))
        & (t["charge"].isNull() | (t["charge"] == charge))
        & ((F.size(t["hydrogens"]) == 0) | F.array_contains(t["hydrogens"], hydrogens))
        & (t["connections"].isNull() | (t["connections"] == connections)),
    )


def matches(structures: Iterable[Structure], atoms: DataFrame, bonds: DataFrame) -> DataFrame:
    """(molecule_id, name, atoms) of every match of every structure, in its own order of atoms, one for each set of atoms.

    atoms: (molecule_id, atom, label), and aromatic, charge, hydrogens where it has
    them; bonds: (molecule_id, a, b), and kind where it has it. A round is one join
    with the steps of that depth and one with the bonds, whatever the number of
    structures: the plan is as long as the longest structure. What a structure
    must be without is found in the same walk and taken away by an anti-join.
    Structures are broadcast; molecules never are, whatever Spark takes their size
    to be, so the driver holds none of them.
    """
    structures = list(structures)
    spark: SparkSession = atoms.sparkSession
    bans, asked = [], {s.name: s for s in structures}
    if len(asked) < len(structures):
        raise ValueError("two structures have one name")
    for s in structures:
        for place, other in s.without:
            name = f"{s.name} without {place} {other.name}"
            asked[name] = Structure(name, other.atoms, other.bonds)
            bans.append((s.name, place, name))
    if not asked:
        return atoms.select("molecule_id", F.lit("").alias("name"), F.array("atom").alias("atoms")).limit(0)
    rows, ends = _tree(list(asked.values()))
    steps = spark.createDataFrame(rows, _STEP)
    whole = {"aromatic": F.lit(None).cast("boolean"), "charge": F.lit(0), "hydrogens": F.lit(0)}
    kind = F.col("kind") if "kind" in bonds.columns else F.lit("")
    ways = bonds.select("molecule_id", "a", "b", kind.alias("kind"))
    ways = ways.union(ways.select("molecule_id", "b", "a", "kind")).distinct()
    degrees = ways.groupBy("molecule_id", F.col("a").alias("atom")).agg(F.count("*").alias("degree"))
    each = atoms.select("molecule_id", "atom", "label", *(F.col(c) if c in atoms.columns else x.alias(c) for c, x in whole.items())).join(degrees.hint("merge"), ["molecule_id", "atom"], "left")
    each = each.withColumn("connections", F.coalesce("degree", F.lit(0)) + F.col("hydrogens")).drop("degree")
    told = ("label", "aromatic", "charge", "hydrogens", "connections")
    first = steps.where("depth = 0").withColumn("label", F.explode(F.array_distinct(F.flatten(F.transform("tests", lambda t: t["labels"])))))
    found = each.join(F.broadcast(first), "label").where(_passes(*map(F.col, told))).select("molecule_id", "node", F.array("atom").alias("atoms"))
    ahead = ways.join(each.withColumnRenamed("atom", "b").hint("merge"), ["molecule_id", "b"]).union(
        each.select("molecule_id", F.col("atom").alias("b"), F.col("atom").alias("a"), F.lit(_STAYS).alias("kind"), *told)
    )
    for depth in range(1, max(r[2] for r in rows) + 1):
        step = F.broadcast(steps.where(F.col("depth") == depth).withColumnRenamed("node", "next"))
        grown = found.join(step, F.col("node") == F.col("parent")).withColumn("a", F.get("atoms", "at")).join(ahead.hint("merge"), ["molecule_id", "a"])
        fits = F.when(F.col("closes").isNotNull(), F.get("atoms", "closes") == F.col("b")).when(F.col("kind") == _STAYS, True).otherwise(~F.array_contains("atoms", F.col("b")))
        kinds = F.when(F.col("kind") == _STAYS, F.array_contains("kinds", _STAYS)).otherwise((F.size("kinds") == 0) | F.array_contains("kinds", F.col("kind")))
        more = F.when(F.col("closes").isNull() & (F.col("kind") != _STAYS), F.array("b")).otherwise(F.array().cast("array<int>"))
        found = grown.where(kinds & fits & _passes(*map(F.col, told))).select("molecule_id", F.col("next").alias("node"), F.concat("atoms", more).alias("atoms"))
    last = F.broadcast(spark.createDataFrame(ends, "node int, name string, places array<int>"))
    found = found.join(last, "node").select("molecule_id", "name", F.transform("places", lambda p: F.get("atoms", p)).alias("atoms"))
    if bans:
        found = settled(found)
        barred = F.broadcast(spark.createDataFrame(bans, "name string, place int, other string"))
        heads = found.select(F.col("molecule_id"), F.col("name").alias("other"), F.col("atoms")[0].alias("head")).distinct()
        bad = found.join(barred, "name").withColumn("head", F.get("atoms", "place")).join(heads.hint("merge"), ["molecule_id", "other", "head"], "left_semi")
        found = found.join(F.broadcast(spark.createDataFrame(sorted({(b[2],) for b in bans}), "name string")), "name", "left_anti")
        found = found.join(bad.select("molecule_id", "name", "atoms").hint("merge"), ["molecule_id", "name", "atoms"], "left_anti")
    least = found.groupBy("molecule_id", "name", F.array_sort("atoms").alias("_set")).agg(F.min("atoms").alias("atoms"))
    return least.select("molecule_id", "name", "atoms")


def holding(searches: dict[str, list[str]], atoms: DataFrame, bonds: DataFrame) -> DataFrame:
    """(search, molecule_id) of molecules that hold all SMILES of a search at once, no two on one atom.

    A text that stands twice in a search must be there twice. Sets of atoms are
    joined by search and molecule, the k-th text of all searches in one round.
    """
    if any(not texts for texts in searches.values()):
        raise ValueError("a search without a fragment")
    spark = atoms.sparkSession
    sizes = {t: len(Structure.of_smiles(t).atoms) for texts in searches.values() for t in texts}
    asked = [(s, k, t) for s, texts in searches.items() for k, t in enumerate(sorted(texts, key=lambda t: (-sizes[t], t)))]
    found = matches([Structure.of_smiles(t) for t in sizes], atoms, bonds).withColumn("set", F.array_sort("atoms"))
    sets = found.join(F.broadcast(spark.createDataFrame(asked, "search string, k int, name string")), "name").select("molecule_id", "search", "k", "set")
    sets = settled(sets)
    rows, last = sets.where("k = 0").select("molecule_id", "search", F.col("set").alias("used")), {s: len(t) - 1 for s, t in searches.items()}
    done = spark.createDataFrame([(s, k) for s, k in last.items()], "search string, last int")
    is_done = lambda test: F.broadcast(done.where(test))
    for k in range(1, max(last.values()) + 1):
        longer = rows.join(is_done(F.col("last") >= k), "search", "left_semi").join(sets.where(F.col("k") == k).hint("merge"), ["molecule_id", "search"])
        grown = longer.where(~F.arrays_overlap("used", "set")).select("molecule_id", "search", F.array_sort(F.concat("used", "set")).alias("used")).distinct()
        rows = rows.join(is_done(F.col("last") < k), "search", "left_semi").unionByName(grown)
    return rows.select("search", "molecule_id").distinct()
