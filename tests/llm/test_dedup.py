"""Exact, near and passage duplicates against brute force, with null, empty, repeated and long texts."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from qaprep.llm import exact_dedup, minhash, suffix_dedup


def lowered(text):
    return (text or "").encode().lower()


@pytest.mark.parametrize("block", [7, 1024])
def test_exact(edge_docs, edge_rows, block):
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.text_sha256, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(edge_docs, block).collect())
    groups = {}
    for i, t in edge_rows:
        groups.setdefault(lowered(t), []).append(i)
    want = []
    for i, t in edge_rows:
        own = groups[lowered(t)]
        ids = [x for x in own if x is not None]
        keep = max(ids) if ids else None
        want.append((i is not None, i or 0, hashlib.sha256(lowered(t)).hexdigest(), keep, len(own), i == keep))
    assert got == sorted(want)


def test_exact_drop(edge_docs, edge_rows):
    kept = exact_dedup.drop_exact_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    texts = [lowered(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({lowered(t) for _, t in edge_rows})


def brute_components(rows):
    sets = []
    for _, t in rows:
        words = lowered(t).split()
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set())
    low = -(1 << 63)
    keys = [low if i is None else i for i, _ in rows]
    parent = {k: k for k in keys}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(keys[a]), find(keys[b])
                parent[max(p, q)] = min(p, q)
    return [(k, len(s), find(k) if s else k) for k, s in zip(keys, sets, strict=True)]


def test_near(edge_docs, edge_rows):
    low = -(1 << 63)
    got = sorted((low if r.doc_id is None else r.doc_id, r.n_shingles, low if r.component_id is None else r.component_id) for r in minhash.near_duplicates(edge_docs).collect())
    assert got == sorted(brute_components(edge_rows))


def test_near_chain_and_blocks(llm, monkeypatch):
    """A long chain of near copies, of which only neighbours are linked, and groups beyond a block."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 80])) for i in range(60)]
    rows += [(1000 + i, " ".join([f"v{j}" if (i * 7 + j) % 41 else f"u{i}x{j}" for j in range(90)])) for i in range(40)]
    monkeypatch.setattr(minhash, "BLOCK", 5)
    docs = llm.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect())
    assert got == sorted(brute_components(rows))


def test_near_drop(edge_docs):
    kept = minhash.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {1, 2, 3, 4, 6} <= set(ids) and not {5, 11, 12, 9} & set(ids)


def test_least_matches_is_the_posterior():
    """Against the posterior summed up on a grid."""
    for n in (24, 48):
        m = minhash.LEAST[n]
        grid = [(k + 0.5) / 20000 for k in range(20000)]
        weight = lambda s, x, n=n: x**s * (1 - x) ** (n - s)
        posterior = lambda s: sum(weight(s, x) for x in grid if x >= 0.75) / sum(weight(s, x) for x in grid)
        assert posterior(m) >= minhash.MISS * 0.9 and (m == 0 or posterior(m - 1) < minhash.MISS * 1.1)


def brute_removed(rows, window):
    out, seen = [], set()
    for key, text in rows:
        change = [0] * (len(text) + 1)
        for s in range(len(text) - window + 1):
            w = text[s : s + window]
            if w in seen:
                change[s] += 1
                change[s + window] -= 1
            seen.add(w)
        gone, depth = [], 0
        for c in change[:-1]:
            depth += c
            gone.append(depth > 0)
        out.append((key, sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), bytes(b for b, g in zip(text, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("most", [suffix_dedup.MOST, 1])
def test_passages(llm, edge_rows, most, monkeypatch):
    """Also with every shared anchor going by single windows (``most`` = 1)."""
    rows = [(i, t) for i, t in {i: t for i, t in edge_rows if i is not None}.items()]
    rows += [(100 + i, ("start %d " % i) + edge_rows[3][1] + (" tail %d" % (i % 3)) * 30) for i in range(12)]
    rows += [(200, "ab" * 300), (201, "b" + "ab" * 200), (202, "é" * 150)]
    monkeypatch.setattr(suffix_dedup, "MOST", most)
    docs = llm.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    window = 100
    repeats = suffix_dedup.repeated_windows(docs, window, most)
    monkeypatch.setattr(suffix_dedup, "repeated_windows", lambda d, w: repeats)
    got = sorted((r.doc_id, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs, window).collect())
    assert got == sorted(brute_removed(sorted((i, (t or "").encode()) for i, t in rows), window))


def test_passages_of_repeated_rows(llm):
    rows = [(1, "x%d " % 5 + "the very same passage " * 20), (1, "x%d " % 5 + "the very same passage " * 20), (None, None), (2, "the very same passage " * 20)]
    got = suffix_dedup.remove_repeats(llm.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == 4 and len({(r.doc_id, r.n_removed) for r in got}) == 3
    assert [r.n_removed for r in got if r.doc_id == 2] == [440]


def test_cut_repeats_keeps_columns(edge_docs):
    cut = suffix_dedup.cut_repeats(edge_docs)
    assert cut.columns == edge_docs.columns and {1, 2, 3} <= {r.doc_id for r in cut.collect()}


def test_run_index_matches():
    index = suffix_dedup.RunIndex([b"banana" * 4, b"ananas" * 3])
    symbols, order = index.symbols, index.order
    text = lambda p: symbols[p : index.ends[index.ends >= p][0]].tolist()
    assert all(text(a) + [0] <= text(b) + [0] for a, b in zip(order[:-1], order[1:], strict=True))
    matches = index.matches()[order]
    for rank in range(1, len(order)):
        a, b = text(order[rank - 1]), text(order[rank])
        common = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert matches[rank] == common


@pytest.mark.parametrize("run", [exact_dedup.exact_duplicates, minhash.near_duplicates, suffix_dedup.remove_repeats, exact_dedup.drop_exact_duplicates, minhash.drop_near_duplicates, suffix_dedup.cut_repeats])
def test_empty(no_docs, run):
    assert run(no_docs).count() == 0


def test_components(llm):
    from qaprep.llm.common import components

    links = [(i, i + 1) for i in range(100)] + [(500, 400), (500, 600)] + [(9000, 8000 - i) for i in range(50)]
    got = {r.node: r.root for r in components(llm.createDataFrame(links, "a bigint, b bigint"), "test").collect()}
    assert got == {**{i: 0 for i in range(101)}, 400: 400, 500: 400, 600: 400, 9000: 7951, **{8000 - i: 7951 for i in range(50)}}


def test_long_words_that_a_polynomial_takes_for_equal(llm):
    """Thue-Morse words and their complements have equal polynomial hashes modulo 2^64."""
    from qaprep.llm.minhash import near_duplicates

    one = "".join("ab"[bin(i).count("1") & 1] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    rows = llm.createDataFrame([(1, one), (2, other), (3, one.upper())], "doc_id bigint, text string")
    assert {(r.doc_id, r.component_id) for r in near_duplicates(rows).collect()} == {(1, 1), (2, 2), (3, 1)}


def test_samples_read_repeated_rows_once(llm):
    from qaprep.llm.common import keyed, sampled

    rows = llm.createDataFrame([(i % 50, f"text {i % 50}") for i in range(3000)], "doc_id bigint, text string").repartition(4)
    assert sampled(keyed(rows), 20).count() == 20 and sampled(keyed(rows), 500).count() == 50


def test_shared_shingles_bound_links():
    """No pair that is linked is ruled out, whatever else its sets share or hold alone."""
    rng = np.random.default_rng(3)
    sets = [set(rng.choice(60, size=rng.integers(1, 50), replace=False).tolist()) for _ in range(60)]
    sets += [set(list(s)[: max(1, len(s) - 1)]) | {1000 + i} for i, s in enumerate(sets[:40])]
    held = Counter(x for s in sets for x in s)
    size = np.array([len(s) for s in sets])
    common = np.array([sum(held[x] > 1 for x in s) for s in sets])
    ruled_out = 0
    for i, a in enumerate(sets):
        may = minhash.reachable(size[i], common[i], size, common)
        linked = np.array([100 * len(a & b) >= 75 * len(a | b) for b in sets])
        assert not (linked & ~may)[np.arange(len(sets)) != i].any()
        ruled_out += int((~may).sum())
    assert ruled_out


def _block_of(sets, left):
    """Both sides of one block pair; the first ``left`` rows are stragglers, as is every row."""
    import pyarrow as pa

    rows = [(side, i) for side in (0, 1) for i in range(left if side == 0 else len(sets))]
    size = [len(sets[i]) for _, i in rows]
    columns = {"side": [s for s, _ in rows], "node": [i for _, i in rows], "comp": [i for _, i in rows], "straggler": [True] * len(rows), "size": size, "common": size}
    columns |= {"sig": [minhash.signature(sets[i]).tobytes() for _, i in rows], "set": [sets[i].tobytes() for _, i in rows]}
    return pa.table(columns).append_column("band", pa.array([0] * len(rows), pa.int32()))


def test_a_block_sends_links_only():
    """Pairs that are near but not linked stay in the block; of linked ones no more leave than join components."""
    rng = np.random.default_rng(5)
    fresh = lambda n: rng.integers(1, 1 << 62, n).astype(np.uint64)
    shared = fresh(160)
    near = [np.sort(np.r_[shared, fresh(40)]) for _ in range(40)]  # 160 of 240: two thirds
    assert all(len(minhash.surviving(*(np.frombuffer(minhash.signature(s).tobytes(), np.uint32)[None] for s in (near[0], x)))) for x in near[1:])
    assert minhash._block_links(_block_of(near, 40)).num_rows == 0
    linked = [np.sort(np.r_[shared, fresh(20)]) for _ in range(40)]
    out = minhash._block_links(_block_of(near[:5] + linked, 45)).to_pydict()
    assert len(out["a"]) == 39 and {*out["a"], *out["b"]} == set(range(5, 45))


def test_anchors_hold_little():
    """Memory for the anchors of a long text and of many short ones does not grow with the batch."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(2)
    text = "".join(map(chr, rng.integers(97, 123, 4 << 20)))
    for texts in ([text], [text[i : i + 2048] for i in range(0, len(text), 2048)]):
        batch = pa.RecordBatch.from_pydict({"key": pa.array(range(len(texts)), pa.int64()), "copy": pa.array([0] * len(texts), pa.int64()), "text": texts})
        tracemalloc.start()
        windows = sum(sum(b.column("n").to_pylist()) for b in suffix_dedup._anchors(100)([batch]))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert windows == sum(len(t) - 99 for t in texts) and peak < 150 << 20


def test_a_slice_and_an_index_take_little_memory():
    """A Python worker keeps what its largest step took, through all later stages of a pipeline."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(4)
    text = "".join(map(chr, rng.integers(97, 123, 2 << 20)))
    batch = pa.RecordBatch.from_pydict({"key": pa.array([0], pa.int64()), "copy": pa.array([0], pa.int64()), "text": [text]})
    pieces = [text[i : i + 170].encode() for i in range(0, suffix_dedup.INDEX_BYTES, 170)]
    for step in (lambda: sum(b.num_rows for b in suffix_dedup._anchors(100)([batch])), lambda: suffix_dedup.marked_windows(pieces * 2)):
        tracemalloc.start()
        step()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 64 << 20
