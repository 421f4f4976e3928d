"""Embedding links against brute force; recall of the graph; odd vectors."""

import pickle

import numpy as np
import pyarrow as pa
import pytest

from qaprep.llm import embedding_dedup


def brute(rows, threshold=0.9):
    keys = [i for i, _ in rows]
    unit = []
    for _, v in rows:
        x = None if v is None or None in v or not np.isfinite(v).all() or not np.any(v) else np.asarray(v, dtype=float)
        unit.append(None if x is None else x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()))
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                links[a] += 1
                links[b] += 1
                p, q = find(a), find(b)
                parent[max(p, q, key=lambda i: keys[i])] = min(p, q, key=lambda i: keys[i])
    return sorted((keys[i], links[i], keys[find(i)]) for i in range(len(rows)))


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=24).tolist()) for i in range(150)]
    centre = rng.normal(size=24)
    rows += [(1000 + i, (centre + 0.15 * rng.normal(size=24)).tolist()) for i in range(200)]  # one large group
    rows += [(2000 + i, (np.array(rows[i % 7][1]) + 0.3 * rng.normal(size=24)).tolist()) for i in range(60)]  # near the threshold
    rows += [(3000 + i, rows[5][1]) for i in range(5)]  # exact copies
    odd = [None, [0.0] * 24, [float("nan")] + [1.0] * 23, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23, [1e-200] * 24, [1e200] * 24]
    return rows + [(4000 + i, v) for i, v in enumerate(odd)]


def test_against_brute_force(llm, vectors):
    frame = llm.createDataFrame([(i, v, 1, "x") for i, v in vectors], "vec_id bigint, embedding array<double>, label int, node string").repartition(3)
    got = embedding_dedup.similar_embeddings(frame).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute(vectors)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_vectors_of_several_widths(llm):
    """One longer vector takes no links from the others, and each width links within itself."""
    rng = np.random.default_rng(6)
    rows = []
    for w, n in ((8, 40), (3, 12), (1, 3), (9, 1)):
        base = rng.normal(size=(n, w))
        rows += [(len(rows) + i, v.tolist()) for i, v in enumerate(np.concatenate([base, base + 0.05 * rng.normal(size=(n, w))]) if n > 1 else base)]
    for parts in (1, 5):
        frame = llm.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(parts)
        got = embedding_dedup.similar_embeddings(frame).collect()
        assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows)


def test_repeated_rows_and_null_ids(llm):
    a, b = [1.0, 0.0, 0.1], [0.0, 1.0, 0.0]
    rows = [(1, a), (1, a), (2, a), (None, b), (3, [0.0, 2.0, 0.1]), (4, None)]
    got = {(r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.similar_embeddings(llm.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    assert got == {(1, 1, 1), (2, 1, 1), (None, 1, None), (3, 1, None), (4, 0, 4)}


def test_empty(llm):
    for rows in ([], [(1, None), (2, [])]):
        out = embedding_dedup.similar_embeddings(llm.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
        assert [(r.n_links, r.vec_id == r.component_id) for r in out] == [(0, True)] * len(rows)


@pytest.mark.parametrize("pairs", [0, 3])
def test_poor_graph_does_not_lose_links(pairs):
    """Few true pairs and a graph without edges: the audit must not pass, and everything is compared."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 48))
    x[1 : 2 * pairs : 2] = x[0 : 2 * pairs : 2] + 0.05 * rng.normal(size=(pairs, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    layers, entry, neighbours = embedding_dedup.Graph(x).state()
    empty = pickle.dumps((x, np.arange(600), ([np.full_like(t, -1) for t in layers], entry, neighbours)))
    raw = [empty] + [v.tobytes() for v in x]
    table = pa.table({"side": pa.array([0] + [1] * 600, pa.int32()), "node": pa.array([0, *range(600)], pa.int64()), "unit": pa.array(raw, pa.binary())})
    out = embedding_dedup._search_shard(0.9)(table).to_pylist()
    assert {(r["a"], r["b"]) for r in out if r["cosine"] > -2} == {(2 * i, 2 * i + 1) for i in range(pairs)}
    audit = next(r for r in out if r["cosine"] < -2)
    assert audit["a"] == audit["b"] > 2 * pairs  # never an empty audit


def test_recall():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 32)) + 2 * rng.normal(size=(30, 32))[rng.integers(0, 30, 3000)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = embedding_dedup.Graph(x)
    found, near = graph.search(x[:200], 64)
    hits = total = 0
    for i in range(200):
        best = set(np.argsort(-(x @ x[i]))[:10].tolist())
        hits += len(best & set(found[i].tolist()))
        total += 10
    assert hits / total >= 0.9 and np.allclose(near[:, 0], 1, atol=1e-5)
