"""Near duplicates among embeddings by hierarchical navigable small-world graphs.

1. Vectors are normalised in double precision. Within a small cell of a random rotation, vectors that lie
   within ``BALL`` of the first one are one ball. Two vectors of a ball are linked for certain, as
   the angle between them is at most twice the ball's. So a group of thousands of near copies is one
   point of the graph, not a clique. Balls only shorten the work: any vector may be its own ball.
2. The balls' centres are dealt to shards by a hash; each shard builds a graph of layers.
3. All centres search every shard, in blocks, for centres whose balls could hold a linked pair. The beam is
   widened (``BEAMS``) until an audit passes: sampled queries of every block and planted ones (points near
   sampled centres of the shard), compared with the whole shard by brute force, must both find ``RECALL``
   of their true neighbours, themselves left out. If the widest beam fails, all queries are compared with all of the shard.
4. The pairs of balls found are decided in double precision: a pair of balls whose centres are so near, or so
   far, that all or none of their members' pairs are linked is counted as a whole; otherwise the members
   are compared one by one, in blocks. Links are united to components.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaprep.llm.common import NO_ID, components, id_of
from qaprep.session import write_through

COSINE = 0.9
#: Angle from a ball's centre to its members (radians); below half of the linking angle.
BALL = 0.15
NEIGHBOURS = 12
BUILD_BEAM = 32
BEAMS = (24, 48, 96, 192, 384)
RECALL = 0.97
#: Planted queries of an audit, and queries of the block drawn at a time: until ``LEAST_TRUE`` true neighbours
#: or ``MOST_AUDITED`` queries.
AUDITED, LEAST_TRUE, MOST_AUDITED = 64, 32, 1024
#: Centres of a shard, on average, and the fewest shards.
SHARD = 16384
LEAST_SHARDS = 4
#: Queries of one search block, and the fewest blocks; members of a ball compared as one block.
BLOCK = 65536
LEAST_BLOCKS = 6
MEMBERS = 128
#: Vectors for which the coarsest cells do; above, each doubling adds a direction.
COARSE = 1 << 17
SEED = 11


def _unit(rows: list[list[float]]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of one width scaled to length 1 (double precision), and which of them can be linked."""
    out = np.array(rows, dtype=np.float64).reshape(len(rows), -1)
    good = np.isfinite(out).all(axis=1)
    out[~good] = 0.0
    peak = np.abs(out).max(axis=1, initial=0.0)
    good &= peak > 0
    out[good] /= peak[good, None]  # no square over- or underflows
    out[good] /= np.sqrt((out[good] ** 2).sum(axis=1, keepdims=True))
    return out, good


def _prepare(directions: int):
    """Unit vectors as bytes, their width, and the cell of each: the signs along fixed directions, and the
    strongest of them. Near copies mostly share it; it decides only who may join a ball. Each width by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = batch.column("vector").to_pylist()
            width = np.array([len(r) if r is not None and None not in r else 0 for r in rows], dtype=np.int64)
            cell, raw = np.zeros(len(rows), dtype=np.int64), [None] * len(rows)
            for w in np.unique(width[width > 0]).tolist():
                at = np.flatnonzero(width == w)
                unit, good = _unit([rows[i] for i in at])
                along = unit @ np.random.default_rng(SEED).standard_normal((directions, w)).T
                cell[at] = ((along > 0) << np.arange(directions)).sum(axis=1).astype(np.int64) * 64 + np.abs(along).argmax(axis=1)
                for i, row in zip(at[good].tolist(), unit[good], strict=True):
                    raw[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(width), pa.array(cell), pa.array(raw, pa.binary())], names=["key", "width", "cell", "unit"])

    return run


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype=np.float64).reshape(len(rows), -1) if rows else np.zeros((0, 1))


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def _balls(ball: float):
    """Greedy balls among the vectors of one sub-cell: each joins the first centre within reach, else it is
    one; all vectors against the centres so far, a block at a time."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        units = _matrix(table.column("unit"))
        keys = table.column("key").to_numpy()
        centre = np.full(len(units), -1, dtype=np.int64)
        angle = np.zeros(len(units))
        left = np.arange(len(units))
        while len(left):
            # centres are chosen one after another from a block, then everything left is held against them
            chosen: list[int] = []
            for i in left[:256].tolist():
                if not chosen or math.acos(min(1.0, max(-1.0, float((units[chosen] @ units[i]).max())))) > ball:
                    chosen.append(i)
            near = _angles(units[left] @ units[chosen].T)
            best = near.argmin(axis=1)
            inside = near[np.arange(len(left)), best] <= ball
            centre[left[inside]] = np.array(chosen)[best[inside]]
            angle[left[inside]] = near[np.arange(len(left)), best][inside]
            left = left[~inside]
        return pa.table({"width": table.column("width"), "key": table.column("key"), "centre": pa.array(keys[centre]), "angle": pa.array(angle), "unit": table.column("unit"), "centre_unit": pa.array([units[c].tobytes() for c in centre], pa.binary())})

    return run


class Graph:
    """A navigable small-world graph of layers over unit vectors; searches run for many queries in step."""

    def __init__(self, vectors: np.ndarray, seed: int = SEED, neighbours: int = NEIGHBOURS, beam: int = BUILD_BEAM):
        self.vectors = vectors.astype(np.float32)
        count = len(vectors)
        rng = np.random.default_rng(seed)
        level = np.minimum((-np.log(rng.random(count)) / math.log(neighbours)).astype(np.int64), 8) if count else np.zeros(0, np.int64)
        order = np.lexsort((rng.permutation(count), -level))  # the upper layers first
        self.order, self.neighbours = order, neighbours
        self.layers = [np.full((count, 2 * neighbours), -1, dtype=np.int32) for _ in range(int(level.max(initial=0)) + 1)]
        self.entry = int(order[0]) if count else -1
        done = 0
        while done < count:  # a block joins a graph at least as large as itself
            block = order[done : done + max(1, min(done, 1024))]
            if done:
                for layer in range(len(self.layers)):
                    own = block[level[block] >= layer]
                    if len(own):
                        self._join(own, layer, beam)
            done += len(block)

    def state(self) -> tuple[list[np.ndarray], int, int]:
        return self.layers, self.entry, self.neighbours

    @classmethod
    def of(cls, vectors: np.ndarray, state: tuple[list[np.ndarray], int, int]) -> Graph:
        """The graph that ``state`` was taken from."""
        graph = cls.__new__(cls)
        graph.vectors = vectors.astype(np.float32)
        graph.layers, graph.entry, graph.neighbours = state
        return graph

    def _join(self, nodes: np.ndarray, layer: int, beam: int) -> None:
        found, near = self.search(self.vectors[nodes], beam, layer)
        # the nodes of a block meet one another, too
        among = self.vectors[nodes] @ self.vectors[nodes].T
        np.fill_diagonal(among, -2.0)
        take = min(self.neighbours, len(nodes) - 1)
        if take:
            best = np.argpartition(-among, take - 1, axis=1)[:, :take]
            found = np.concatenate([found, nodes[best]], axis=1)
            near = np.concatenate([near, np.take_along_axis(among, best, axis=1)], axis=1)
        order = np.argsort(-near, axis=1, kind="stable")
        found, near = np.take_along_axis(found, order, axis=1), np.take_along_axis(near, order, axis=1)
        keep = self._diverse(found, near)
        table = self.layers[layer]
        table[nodes, : self.neighbours] = keep
        # links back: free places first, beyond them the nearest and most diverse stay
        a, b = np.repeat(nodes, self.neighbours), keep.ravel().astype(np.int64)
        a, b = a[b >= 0], b[b >= 0]
        order = np.argsort(b, kind="stable")
        a, b = a[order], b[order]
        touched, first, counts = np.unique(b, return_index=True, return_counts=True)
        wide = int(counts.max()) if len(counts) else 0
        new = np.full((len(touched), wide), -1, dtype=np.int64)
        new[np.repeat(np.arange(len(touched)), counts), np.arange(len(b)) - np.repeat(first, counts)] = a
        every = np.concatenate([table[touched].astype(np.int64), new], axis=1)
        near = np.where(every >= 0, np.einsum("nd,nkd->nk", self.vectors[touched], self.vectors[every]), -2.0)
        order = np.argsort(-near, axis=1, kind="stable")[:, : 2 * self.neighbours]
        best = np.take_along_axis(every, order, axis=1)
        table[touched, : best.shape[1]] = best

    def _diverse(self, found: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Of candidates in falling order those that are nearer to the node than to a chosen one; places
        that stay free go to the nearest others."""
        rows, wide = found.shape
        out = np.full((rows, self.neighbours), -1, dtype=np.int32)
        count = np.zeros(rows, dtype=np.int64)
        used = np.zeros(found.shape, dtype=bool)
        for j in range(wide):
            node = found[:, j]
            ok = (node >= 0) & (near[:, j] > -1.5) & (count < self.neighbours)
            chosen = np.where(out >= 0, np.einsum("nd,nkd->nk", self.vectors[node], self.vectors[out]), -2.0)
            ok &= (chosen <= near[:, j][:, None]).all(axis=1) & (out != node[:, None]).all(axis=1)
            out[ok, count[ok]] = node[ok]
            count[ok] += 1
            used[:, j] = ok
        for j in range(wide):
            node = found[:, j]
            ok = ~used[:, j] & (node >= 0) & (near[:, j] > -1.5) & (count < self.neighbours) & (out != node[:, None]).all(axis=1)
            out[ok, count[ok]] = node[ok]
            count[ok] += 1
        return out

    def search(self, queries: np.ndarray, beam: int, stop: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest nodes met on layer ``stop``, and their cosines (-2 in free places)."""
        queries = queries.astype(np.float32)
        start = np.full((len(queries), 1), self.entry, dtype=np.int64)
        for layer in range(len(self.layers) - 1, stop, -1):
            start = self._walk(queries, start, 1, layer)[0][:, :1]
        return self._walk(queries, start, beam, stop)

    def _walk(self, queries: np.ndarray, start: np.ndarray, beam: int, layer: int) -> tuple[np.ndarray, np.ndarray]:
        rows, table, wide = len(queries), self.layers[layer], 2 * self.neighbours
        node = np.full((rows, beam), -1, dtype=np.int64)
        near = np.full((rows, beam), -2.0, dtype=np.float32)
        open_ = np.zeros((rows, beam), dtype=bool)
        node[:, 0] = start[:, 0]
        near[:, 0] = np.einsum("nd,nd->n", queries, self.vectors[start[:, 0]])
        open_[:, 0] = True
        live = np.arange(rows)
        while len(live):
            at = np.where(open_[live], near[live], -3.0).argmax(axis=1)
            going = open_[live, at]
            live, at = live[going], at[going]
            if len(live) == 0:
                break
            open_[live, at] = False
            following = table[node[live, at]].astype(np.int64)
            seen = (following[:, :, None] == node[live][:, None, :]).any(axis=2) | (following < 0)
            score = np.einsum("nd,nkd->nk", queries[live], self.vectors[following])
            score[seen] = -2.0
            all_near = np.concatenate([near[live], score], axis=1)
            all_node = np.concatenate([node[live], np.where(seen, -1, following)], axis=1)
            all_open = np.concatenate([open_[live], ~seen], axis=1)
            best = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
            near[live], node[live], open_[live] = (np.take_along_axis(x, best, axis=1) for x in (all_near, all_node, all_open))
        order = np.argsort(-near, axis=1, kind="stable")
        return np.take_along_axis(node, order, axis=1), np.take_along_axis(near, order, axis=1)


def _build(table: pa.Table) -> pa.Table:
    """The graph of one shard, as bytes."""
    table = table.sort_by("node")
    units, nodes = _matrix(table.column("unit")), table.column("node").to_numpy()
    raw = pickle.dumps((units, nodes, Graph(units).state()))
    return pa.table({"width": table.column("width")[:1], "shard": table.column("shard")[:1], "node": pa.array([0], pa.int64()), "unit": pa.array([raw], pa.binary())})


def _near(graph: Graph, units: np.ndarray, queries: np.ndarray, reach: float, beam: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (query, place in ``units``, cosine) with a cosine of at least ``reach``: those the graph leads to, or
    all of them without a beam."""
    rows, places, cosines = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for at in range(0, len(queries), 512):
        some = queries[at : at + 512]
        if beam is None:
            row, col = np.nonzero(some @ units.T >= reach)
            rows.append(at + row)
            places.append(col)
            cosines.append(np.einsum("nd,nd->n", some[row], units[col]))
            continue
        found, score = graph.search(some, beam)
        # a full beam of near ones may hide more: those queries look on with a wider one
        wide = beam
        full = np.flatnonzero((score[:, -1] >= reach - 1e-4) & (score[:, -1] > -1.5))
        first = np.setdiff1d(np.arange(len(found)), full)
        parts = [(first, found[first], score[first])]
        if wide >= len(units):
            parts.append((full, found[full], score[full]))
        while len(full) and wide < len(units):
            wide = min(4 * wide, len(units))
            more, more_score = graph.search(some[full], wide)
            still = (more_score[:, -1] >= reach - 1e-4) & (more_score[:, -1] > -1.5) & (wide < len(units))
            parts.append((full[~still], more[~still], more_score[~still]))
            full = full[still]
        for who, f, score in parts:
            row, col = np.nonzero((score > -1.5) & (score >= reach - 1e-4))
            x, y = who[row], f[row, col]
            exact = np.einsum("nd,nd->n", some[x], units[y])
            keep = exact >= reach
            rows.append(at + x[keep])
            places.append(y[keep])
            cosines.append(exact[keep])
    return np.concatenate(rows), np.concatenate(places), np.concatenate(cosines)


def _planted(units: np.ndarray, reach: float, rng: np.random.Generator) -> np.ndarray:
    """Points within reach of sampled units, in random directions: queries that have a true neighbour."""
    base = units[rng.permutation(len(units))[:AUDITED]]
    aside = rng.standard_normal(base.shape)
    aside -= np.einsum("nd,nd->n", aside, base)[:, None] * base
    size = np.sqrt((aside**2).sum(axis=1, keepdims=True))
    aside = np.where(size > 1e-9, aside / np.maximum(size, 1e-9), 0.0)
    angle = math.acos(max(-1.0, min(1.0, reach))) * rng.uniform(0.0, 0.999, (len(base), 1))
    out = np.cos(angle) * base + np.sin(angle) * aside
    return out / np.sqrt((out**2).sum(axis=1, keepdims=True))


def _audited_beam(graph: Graph, units: np.ndarray, nodes: np.ndarray, queries: np.ndarray, names: np.ndarray, reach: float) -> tuple[int | None, int, int]:
    """The first beam that finds ``RECALL`` of the true neighbours of the block's own queries and of planted ones, or
    None (compare everything); and how many neighbours of the audited it found, and how many are true."""
    rng = np.random.default_rng(SEED)
    order, drawn, true = rng.permutation(len(queries)), [], 0
    for at in range(0, min(len(order), MOST_AUDITED), AUDITED):
        some = order[at : min(at + AUDITED, MOST_AUDITED)]
        near = (queries[some] @ units.T >= reach) & (names[some][:, None] != nodes[None, :])
        true += int(near.sum())
        drawn.append(some[near.any(axis=1)])  # the others have nothing to find
        if true >= LEAST_TRUE:
            break
    own, planted = np.concatenate(drawn), _planted(units, reach, rng)
    planted_true = int((planted @ units.T >= reach).sum())
    for beam in BEAMS:
        row, place, _ = _near(graph, units, queries[own], reach, min(beam, len(units)))
        hits = int((names[own][row] != nodes[place]).sum())
        if hits < RECALL * true:
            continue
        planted_hits = len(_near(graph, units, planted, reach, min(beam, len(units)))[0])
        if planted_hits >= RECALL * planted_true:
            return min(beam, len(units)), hits + planted_hits, true + planted_true
    return None, true + planted_true, true + planted_true


def _search_shard(reach: float):
    """One shard against one block of queries: the centres whose balls could hold a linked pair."""

    def run(table: pa.Table) -> pa.Table:
        side = np.asarray(table.column("side"))
        asking = table.filter(pa.array(side == 1))
        if not (side == 0).any() or asking.num_rows == 0:  # no centre was dealt to this shard, or block
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "cosine": pa.array([], pa.float64())})
        units, nodes, state = pickle.loads(table.column("unit")[int(np.flatnonzero(side == 0)[0])].as_py())
        graph = Graph.of(units, state)
        queries, names = _matrix(asking.column("unit")), asking.column("node").to_numpy()
        beam, hits, true = _audited_beam(graph, units, nodes, queries, names, reach)
        row, place, cosine = _near(graph, units, queries, reach, beam)
        x, y = names[row], nodes[place]
        keep = x != y
        a, b = np.minimum(x[keep], y[keep]), np.maximum(x[keep], y[keep])
        return pa.table({"a": pa.array(np.r_[a, hits], pa.int64()), "b": pa.array(np.r_[b, true], pa.int64()), "cosine": pa.array(np.r_[cosine[keep], -9.0])})

    return run


def _member_pairs(threshold: float):
    """Links between the members of two balls' blocks, one by one: for each member how many."""

    def run(table: pa.Table) -> pa.Table:
        left, right = (table.filter(pa.array(np.asarray(table.column("side")) == s)) for s in (0, 1))
        x, y = _matrix(left.column("unit")), _matrix(right.column("unit"))
        a, b = left.column("key").to_numpy(), right.column("key").to_numpy()
        if len(a) == 0 or len(b) == 0:
            return pa.table({"key": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "other": pa.array([], pa.int64())})
        linked = x @ y.T >= threshold
        keys, links = np.r_[a, b], np.r_[linked.sum(axis=1), linked.sum(axis=0)]
        other = np.r_[b[linked.argmax(axis=1)], a[linked.argmax(axis=0)]]
        some = links > 0
        return pa.table({"key": pa.array(keys[some]), "links": pa.array(links[some].astype(np.int64)), "other": pa.array(other[some])})

    return run


def neighbour_balls(balls: DataFrame, centres: DataFrame, threshold: float, ball: float) -> tuple[DataFrame, DataFrame]:
    """Pairs of centres (a, b, cosine) whose balls could hold a linked pair, and the audits (found, true)."""
    widest = balls.agg(F.max("angle")).first()[0] or 0.0
    reach = math.cos(min(math.pi, math.acos(threshold) + 2 * widest + 1e-9))
    if centres.isEmpty():
        empty = centres.sparkSession.createDataFrame([], "a bigint, b bigint, cosine double")
        return empty, empty.selectExpr("a AS found", "b AS true_neighbours")
    # vectors meet only others of their width: each has shards and blocks of its own
    dealing = lambda size, least: F.greatest(F.lit(least), F.ceil(F.count("*") / F.lit(size))).cast("bigint")
    widths = write_through(centres.groupBy("width").agg(dealing(SHARD, LEAST_SHARDS).alias("shards"), dealing(BLOCK, LEAST_BLOCKS).alias("blocks")), "widths")
    by_width = centres.select("width", "node", "unit").join(widths, "width")
    dealt = by_width.select("width", "node", "unit", F.pmod(F.xxhash64("node", F.lit(1)), "shards").alias("shard"))
    graphs = write_through(dealt.groupBy("width", "shard").applyInArrow(_build, "width bigint, shard bigint, node bigint, unit binary"), "graphs")
    own = graphs.join(widths, "width").select("width", "shard", "node", "unit", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"), F.lit(0).alias("side"))
    asking = by_width.select("width", F.explode(F.expr("sequence(0L, shards - 1)")).alias("shard"), "node", "unit", F.pmod(F.xxhash64("node", F.lit(2)), "blocks").alias("block"), F.lit(1).alias("side"))
    found = own.unionByName(asking).groupBy("width", "shard", "block").applyInArrow(_search_shard(reach), "a bigint, b bigint, cosine double")
    found = write_through(found, "neighbours")
    return found.filter("cosine > -2").dropDuplicates(["a", "b"]), found.filter("cosine < -2").select(F.col("a").alias("found"), F.col("b").alias("true_neighbours"))


def similar_embeddings(vectors: DataFrame, threshold: float = COSINE, ball: float = BALL, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors``.

    Vectors that are null, zero, or hold null or non-finite components link with nothing, others with those of their width. Rows that repeat an
    id with an equal vector are one vector, not links of one another; several vectors under one id are in
    one component and their links add up. A null id is an id below all others. Empty in, empty out."""
    rows = vectors.select(F.coalesce(F.col(id_column).cast("bigint"), F.lit(NO_ID)).alias("key"), F.col(vector_column).cast("array<double>").alias("vector"))
    directions = 8 + max(0, (vectors.count() // COARSE).bit_length())
    prepared = write_through(rows.mapInArrow(_prepare(directions), "key bigint, width bigint, cell bigint, unit binary"), "units")
    linkable = prepared.filter("unit IS NOT NULL").dropDuplicates(["key", "unit"])
    # a cell that holds many vectors is split at random; each part makes its own balls
    parts = write_through(linkable.groupBy("width", "cell").agg(F.ceil(F.count("*") / F.lit(MEMBERS)).cast("int").alias("parts")), "cells")
    dealt = linkable.join(parts, ["width", "cell"]).withColumn("part", F.pmod(F.xxhash64("key", F.lit(3)), "parts"))
    balls = write_through(dealt.groupBy("width", "cell", "part").applyInArrow(_balls(ball), "width bigint, key bigint, centre bigint, angle double, unit binary, centre_unit binary"), "balls")
    balls = balls.withColumn("node", F.xxhash64("centre", "centre_unit"))
    centres = write_through(balls.groupBy("node").agg(F.first("width").alias("width"), F.max("centre_unit").alias("unit"), F.count("*").alias("members"), F.max("angle").alias("radius"), F.min("key").alias("low")), "centres")
    pairs, audits = neighbour_balls(balls, centres, threshold, ball)
    pooled = audits.agg(F.sum("found").alias("found"), F.sum("true_neighbours").alias("true_neighbours")).first()
    if pooled.true_neighbours and pooled.found < RECALL * pooled.true_neighbours:
        raise RuntimeError(f"audits found {pooled.found} of {pooled.true_neighbours} neighbours")

    limit = math.acos(threshold)
    side = centres.select("node", "members", "radius", "low")
    both = pairs.join(side.toDF("a", "members_a", "radius_a", "low_a"), "a").join(side.toDF("b", "members_b", "radius_b", "low_b"), "b")
    between, reach = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), "cosine"))), F.col("radius_a") + F.col("radius_b")
    both = both.withColumn("kind", F.when(between + reach <= limit - 1e-9, "all").when(between - reach > limit + 1e-9, "none").otherwise("some"))
    both = write_through(both, "ball-pairs")
    whole = both.filter("kind = 'all'")
    per_ball = whole.select(F.col("a").alias("node"), F.col("members_b").alias("n")).union(whole.select(F.col("b").alias("node"), F.col("members_a").alias("n"))).groupBy("node").agg(F.sum("n").alias("n"))
    blocks_of = lambda c: F.ceil(F.col(c) / F.lit(MEMBERS)).cast("bigint")
    some = both.filter("kind = 'some'").select("a", "b", blocks_of("members_a").alias("blocks_a"), blocks_of("members_b").alias("blocks_b"))
    some = some.withColumn("i", F.explode(F.expr("sequence(0L, blocks_a - 1)"))).withColumn("j", F.explode(F.expr("sequence(0L, blocks_b - 1)")))
    members = balls.join(centres.select("node", blocks_of("members").alias("blocks")), "node").select("node", "key", "unit", F.pmod(F.xxhash64("key", F.lit(4)), "blocks").alias("at"))
    members = write_through(members, "members")
    left = some.join(members.select(F.col("node").alias("a"), F.col("at").alias("i"), "key", "unit"), ["a", "i"]).withColumn("side", F.lit(0))
    right = some.join(members.select(F.col("node").alias("b"), F.col("at").alias("j"), "key", "unit"), ["b", "j"]).withColumn("side", F.lit(1))
    one_by_one = left.unionByName(right).select("a", "b", "i", "j", "side", "key", "unit").groupBy("a", "b", "i", "j").applyInArrow(_member_pairs(threshold), "key bigint, links bigint, other bigint")
    one_by_one = write_through(one_by_one, "member-links")

    counted = balls.select("key", "node").join(write_through(side, "sides"), "node").join(write_through(per_ball, "per-ball"), "node", "left")
    counted = counted.select("key", (F.col("members") - 1 + F.coalesce("n", F.lit(0))).alias("links")).union(one_by_one.select("key", "links"))
    counts = write_through(counted.groupBy("key").agg(F.sum("links").alias("n_links")), "counts")
    # a ball's members are linked through its smallest key; pairs of balls and of members through theirs
    inner = write_through(balls.select("key", "node").join(write_through(side.select("node", "low"), "lows"), "node").select("key", "low"), "inner")
    links = whole.select(F.col("low_a").alias("a"), F.col("low_b").alias("b")).union(one_by_one.select("key", "other"))
    to_low = inner.groupBy("key").agg(F.min("low").alias("low"), F.max("low").alias("high"))
    to_low = write_through(to_low, "to-low")
    several = to_low.filter("low != high").select(F.col("low").alias("a"), F.col("high").alias("b"))
    mapped = links.join(to_low.select(F.col("key").alias("a"), F.col("low").alias("low_a")), "a").join(to_low.select(F.col("key").alias("b"), F.col("low").alias("low_b")), "b").select(F.col("low_a").alias("a"), F.col("low_b").alias("b"))
    found = write_through(components(mapped.union(several), "embeddings"), "found")
    roots = to_low.select("key", "low").join(found.select(F.col("node").alias("low"), "root"), "low", "left").select("key", F.coalesce("root", "low").alias("root"))
    out = prepared.select("key").join(counts, "key", "left").join(write_through(roots, "roots"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    return out.select(id_of(F.col("key")).alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), id_of(F.col("root")).alias("component_id"), (F.col("key") == F.col("root")).alias("kept"))
