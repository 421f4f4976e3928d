"""Ring arrays, stereo counts, and the longest open carbon chain."""

from __future__ import annotations

import re
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaprep.functions.smiles import Scan, atoms, bonds, parsable


def sort_rings(rings: Column, base: int = 0) -> Column:
    """Atoms ascending inside a ring, rings by (highest, lowest) atom ascending."""
    inner = F.transform(rings, lambda r: F.array_sort(F.transform(r, lambda a: a + base)))
    ordered = F.array_sort(F.transform(inner, lambda r: F.struct(F.array_max(r).alias("hi"), F.array_min(r).alias("lo"), r.alias("ring"))))
    return F.transform(ordered, lambda s: s["ring"])


def ring_size_counts(rings: Column, aromatic: Column | None = None) -> Column:
    """Rings in all and by size; with a flag per ring also the aromatic ones."""
    count = lambda items: F.size(items).cast("bigint")
    of_size = lambda n: count(F.filter(rings, lambda r: F.size(r) == n))
    out = [count(rings).alias("total_rings"), of_size(5).alias("five_membered_rings"), of_size(6).alias("six_membered_rings")]
    if aromatic is not None:
        flagged = F.filter(F.arrays_zip(rings.alias("ring"), aromatic.alias("flag")), lambda z: z["flag"])
        sized = lambda n: count(F.filter(flagged, lambda z: F.size(z["ring"]) == n))
        out += [
            count(flagged).alias("aromatic_rings"),
            sized(5).alias("aromatic_five_membered_rings"),
            sized(6).alias("aromatic_six_membered_rings"),
        ]
    return F.struct(*out)


def fused_ring_count(rings: Column) -> Column:
    """Rings that share a bond, that is two atoms, with another ring."""
    indexed = F.transform(rings, lambda r, i: F.struct(r.alias("ring"), i.alias("no")))
    shares = lambda p, q: (p["no"] != q["no"]) & (F.size(F.array_intersect(p["ring"], q["ring"])) >= 2)
    return F.size(F.filter(indexed, lambda p: F.exists(indexed, lambda q: shares(p, q)))).cast("bigint")


def stereo_summary(def_centers: Column, undef_centers: Column, def_bonds: Column) -> Column:
    """Stereocenters and stereo double bonds from the counts in the compound table."""
    return F.struct(
        (def_centers + undef_centers).cast("bigint").alias("stereocenters"),
        def_bonds.cast("bigint").alias("stereo_bonds"),
    )


def _path(parent: dict[int, int], a: int, b: int) -> set[int]:
    """Atoms on the written-bond path between two atoms."""
    up = [a]
    while up[-1] in parent:
        up.append(parent[up[-1]])
    above, walked = set(up), []
    while b not in above:
        walked.append(b)
        if b not in parent:
            return set()  # the closure joins two components: no ring
        b = parent[b]
    return set(up[: up.index(b) + 1]) | set(walked)


CARBON = re.compile(r"\[?[0-9]*(C(?![a-z])|c(?![a-z]))")


def _longest_open_chain(atom_tokens: list[str], links: list[tuple[int, int, bool]]) -> list[int]:
    """Longest path over carbons outside rings. Equally long paths: the lowest start wins, then
    the neighbour that was bonded first."""
    parent = {b: a for a, b, closing in links if not closing}
    in_ring: set[int] = set()
    for a, b, closing in links:
        if closing:
            in_ring |= _path(parent, a, b)
    open_carbon = {i for i, token in enumerate(atom_tokens) if CARBON.match(token) and i not in in_ring}
    near: dict[int, list[int]] = defaultdict(list)
    for child, above in sorted(parent.items()):
        if child in open_carbon and above in open_carbon:
            near[child].insert(0, above)
            near[above].append(child)

    best: list[int] = []
    for start in sorted(open_carbon):
        if len(near[start]) > 1:
            continue  # the ends of a longest path have at most one neighbour
        came_from, depth, order, stack = {start: -1}, {start: 1}, [], [start]
        while stack:
            at = stack.pop()
            order.append(at)
            for other in reversed(near[at]):
                if other not in came_from:
                    came_from[other], depth[other] = at, depth[at] + 1
                    stack.append(other)
        end = max(order, key=lambda i: depth[i])
        if depth[end] > len(best):
            best = []
            while end != -1:
                best.append(end)
                end = came_from[end]
    return sorted(best)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _chain_batch(
    atom_tokens: pd.Series, starts: pd.Series, ends: pd.Series, closures: pd.Series, base: pd.Series
) -> pd.Series:
    out = []
    for tokens, a, b, closing, first in zip(atom_tokens, starts, ends, closures, base):
        out.append([i + first for i in _longest_open_chain(list(tokens), list(zip(a, b, closing)))])
    return pd.Series(out)


def chain_bonds(smiles: Column) -> Column:
    """The bonds ``longest_chain`` needs, to be attached as a column of their own first: the fold
    that makes them must not be merged into the call of a Python function. Null for text that does not parse."""
    return F.when(parsable(smiles), bonds(smiles))


def longest_chain(smiles: Column | Scan, links: Column, base: int = 1) -> Column:
    """Sorted atom numbers of the longest open carbon chain; empty without ``links``, as for text that does
    not parse."""
    text = smiles.text if isinstance(smiles, Scan) else smiles
    usable = F.when(links.isNotNull(), text).otherwise(F.lit(""))
    part = lambda name, kind: F.coalesce(links[name], F.array().cast(f"array<{kind}>"))
    return _chain_batch(atoms(usable), part("a", "int"), part("b", "int"), part("ring_closure", "boolean"), F.lit(base))
