"""Aromatic rings of molecules that are drawn with single and double bonds."""

from __future__ import annotations

from itertools import chain

from fragmill.functions.rings import smallest_rings

#: Rings that are looked at together at most, where they share bonds.
FUSED = 6


def _donated(i: int, atoms: list[tuple], near: list[list[tuple[int, str, bool]]]) -> int | None:
    """The electrons that an atom gives a ring, or None if it cannot stand in an aromatic one.

    An atom with a double bond in a ring gives one, one with a double bond out of it
    to N, O or S none, one without a double bond two if it has a free pair.
    """
    label, aromatic, charge, hydrogens = atoms[i]
    double = [(j, ring) for j, kind, ring in near[i] if kind == "="]
    connections = len(near[i]) + hydrogens
    if label not in ("B", "C", "N", "O", "P", "S", "Se") or len(double) > 1 or any(kind == "#" for _, kind, _ in near[i]) or connections > 3:
        return None
    if double:
        j, ring = double[0]
        return 1 if ring else 0 if label == "C" and atoms[j][0] in ("N", "O", "S") else None
    if label == "C":
        return {-1: 2, 1: 0}.get(charge, 1 if aromatic else None)
    if label in ("N", "P"):
        return 2 if connections - charge == 3 and charge <= 0 else 1 if aromatic else None
    return 0 if label == "B" else 2 if connections == 2 and not charge else 1 if aromatic else None


def aromatic(atoms: list[tuple], bonds: list[tuple]) -> tuple[set[int], set[int]]:
    """The numbers of the atoms and of the bonds that are aromatic.

    atoms have (label, aromatic, charge, hydrogens), bonds (a, b, kind). A ring is
    aromatic if its atoms give 4n + 2 electrons. Rings that share bonds are then
    looked at together, two and more, while one of them is not: if all their atoms
    give 4n + 2, the bonds that lie in one of them only are aromatic.
    """
    pairs = [b[:2] for b in bonds]
    rings = smallest_rings(pairs)
    within = set(chain.from_iterable(rings))
    near: list[list[tuple[int, str, bool]]] = [[] for _ in atoms]
    for n, (a, b, kind) in enumerate(bonds):
        near[a].append((b, kind, n in within))
        near[b].append((a, kind, n in within))
    given = [_donated(i, atoms, near) for i in range(len(atoms))]
    members = [{a for n in ring for a in pairs[n]} for ring in rings]
    usable = [k for k, own in enumerate(members) if all(given[a] is not None for a in own)]
    found_atoms, found_bonds, done = set(), set(), set()

    def take(together: frozenset[int]) -> None:
        own = set().union(*(members[k] for k in together))
        if sum(given[a] for a in own) % 4 == 2:
            found_atoms.update(own)
            found_bonds.update(n for k in together for n in rings[k] if sum(n in rings[x] for x in together) == 1)
            done.update(together)

    level = {frozenset([k]) for k in usable}
    for _ in range(FUSED):
        for together in sorted(level, key=sorted):
            if not together <= done:
                take(together)
        if set(usable) <= done:
            break
        level = {t | {k} for t in level for k in usable if k not in t and any(set(rings[k]) & set(rings[x]) for x in t)}
    return found_atoms, found_bonds
