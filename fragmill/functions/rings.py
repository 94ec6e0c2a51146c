"""Rings of one molecule: which bonds lie in a ring, and a smallest set of rings that all others are made of."""

from __future__ import annotations

from collections import defaultdict


def _core(bonds: list[tuple[int, int]]) -> set[int]:
    """The numbers of the bonds that are left when ends are taken off again and again."""
    left, at = set(range(len(bonds))), defaultdict(set)
    for i, bond in enumerate(bonds):
        for atom in bond:
            at[atom].add(i)
    ends = [a for a, own in at.items() if len(own) == 1]
    while ends:
        a = ends.pop()
        for i in list(at[a]):
            left.discard(i)
            for b in bonds[i]:
                at[b].discard(i)
                if len(at[b]) == 1:
                    ends.append(b)
    return left


def smallest_rings(bonds: list[tuple[int, int]]) -> list[list[int]]:
    """Bond numbers of each ring of a smallest cycle basis, shortest ring first, ties by atoms.

    From each atom of a ring or between rings the shortest ways to all others are
    found; each further bond closes a candidate. Candidates are bit masks of bonds,
    taken shortest first and kept if no sum of those before is the same.
    """
    core, at = _core(bonds), defaultdict(list)
    for i in sorted(core):
        a, b = bonds[i]
        at[a].append((b, i))
        at[b].append((a, i))
    candidates: dict[int, tuple] = {}
    for root in sorted(at):
        way, depth, level = {root: 0}, {root: 0}, [root]
        while level:
            after = []
            for a in level:
                for b, i in at[a]:
                    if b not in way:
                        way[b], depth[b] = way[a] | 1 << i, depth[a] + 1
                        after.append(b)
            level = after
        for i in core:
            a, b = bonds[i]
            if a in way and not (way[a] | way[b]) >> i & 1 and not way[a] & way[b]:
                ring = way[a] | way[b] | 1 << i
                if ring not in candidates:
                    own = [k for k in core if ring >> k & 1]
                    candidates[ring] = (len(own), sorted({x for k in own for x in bonds[k]}), own)
    kept, rings = {}, []
    for ring, (_, _, own) in sorted(candidates.items(), key=lambda x: x[1]):
        rest = ring
        while rest and (top := rest.bit_length()) in kept:
            rest ^= kept[top]
        if rest:
            kept[rest.bit_length()] = rest
            rings.append(own)
    return rings


def ring_bonds(bonds: list[tuple[int, int]]) -> set[int]:
    """The numbers of the bonds that lie in a ring: those that a walk in depth finds no bridges."""
    at, order, low, bridges = defaultdict(list), {}, {}, set()
    for i, (a, b) in enumerate(bonds):
        at[a].append((b, i))
        at[b].append((a, i))
    for start in at:
        if start in order:
            continue
        order[start] = low[start] = len(order)
        stack = [(start, -1, iter(at[start]))]
        while stack:
            a, came, ahead = stack[-1]
            step = next(ahead, None)
            if step is None:
                stack.pop()
                if stack:
                    low[stack[-1][0]] = min(low[stack[-1][0]], low[a])
                    if low[a] > order[stack[-1][0]]:
                        bridges.add(came)
            elif step[1] != came:
                if step[0] in order:
                    low[a] = min(low[a], order[step[0]])
                else:
                    order[step[0]] = low[step[0]] = len(order)
                    stack.append((step[0], step[1], iter(at[step[0]])))
    return set(range(len(bonds))) - bridges
