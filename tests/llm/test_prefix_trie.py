"""The trie of conversations against plain counting of prefixes."""

import hashlib
import random
import zlib

import pytest
from llm_cases import SF, needs_tables

from qaprep.llm import prefix_trie
from qaprep.llm.queries import QUERIES

KINDS = "conv_id bigint, turn bigint, role string, text string"


def test_two_fattest():
    for low in range(40):
        for high in range(low + 1, 41):
            best = max(range(low + 1, high + 1), key=lambda x: (x & -x, x))
            assert prefix_trie.two_fattest(low, high) == best


def signatures(turns):
    out, state = b"", hashlib.blake2b(digest_size=16)
    for t in turns:
        state.update(repr(t).encode())
        out += state.digest()
    return out


@pytest.mark.parametrize("seed", range(6))
def test_z_fast_trie(seed):
    rng = random.Random(seed)
    strings = {tuple(rng.choice("ab" if seed % 2 else "abcdefgh") for _ in range(rng.choice([1, 2, 5, 20, 60]))) for _ in range(400)}
    strings |= {s[: rng.randint(1, len(s))] for s in strings} | {tuple("a" * n) for n in range(1, 50, 3)}
    strings = sorted(strings)
    rng.shuffle(strings)
    trie = prefix_trie.ZFastTrie(prefix_trie.ROOT)
    trie.fill([signatures(s) for s in strings])
    # compacted nodes: ends of strings and places where they part
    follow = {}
    for s in strings:
        for d in range(len(s)):
            follow.setdefault(s[:d], set()).add(s[d])
    want = {s for s in strings} | {p for p, n in follow.items() if len(n) > 1 and p}
    got = {strings[trie.through[i]][: trie.extent[i]] for i in range(1, len(trie.start))}
    assert got == want and len(trie.start) == len(want) + 1
    assert all(strings[trie.through[n]][: trie.extent[n]] == s for n, s in zip(trie.ends, strings, strict=True))
    for i in range(1, len(trie.start)):
        s, up = strings[trie.through[i]], trie.parent[i]
        assert trie.start[i] == trie.extent[up] < trie.extent[i] and s[: trie.start[i]] == (strings[trie.through[up]][: trie.extent[up]] if up else ())
        depth = prefix_trie.two_fattest(trie.start[i], trie.extent[i])
        assert trie.handles[signatures(s)[16 * depth - 16 : 16 * depth]] == i
    assert len(trie.handles) == len(trie.start) - 1


def rebuilt(rows):
    """Turns of each conversation as the query's contract has them."""
    own = {}
    for c, turn, role, text in rows:
        own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(b"" if c is None else str(c).encode()) % 6
        base = [] if c is None else own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])
        out[c] = base[:h] + ts[h:]
    return out


def plain(convs):
    order = lambda c: -(1 << 63) if c is None else c
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children, leaves, saved = {}, {}, {}
    for p in members:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] = leaves.get(p[:d], 0) + (p not in children)
            saved[p[:d]] = saved.get(p[:d], 0) + ((len(own) - 1) * len(p[-1][1]) if p else 0)
    low = {p: min(own, key=order) for p, own in members.items()}
    ids = lambda p: ",".join("" if c is None else str(c) for c in sorted(ends.get(p, []), key=order))
    return sorted(
        (str(low[p]), len(p), str(low[p[:-1]] if p else None), len(members[p]), children.get(p, 0), leaves[p], saved[p], hashlib.sha256(ids(p).encode()).hexdigest()) for p in members
    )


def rows_of(df):
    return sorted((str(r[0]), r[1], str(r[2]), *r[3:]) for r in df.collect())


def made(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 40), *range(95, 130), 200, 301, 302, -5, -120, -100, None]:
        start = rng.choice([[], [("system", "be kind")], [("system", "be kind"), ("user", "héllo")]])
        turns = start + [(rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "b", "ab", "", None, "日本"])) for _ in range(rng.choice([1, 1, 2, 5, 9]))]
        numbers = list(range(len(turns)))
        if rng.random() < 0.3:
            numbers[rng.randrange(len(turns))] = None
        rows += [(c, n, r, t) for n, (r, t) in zip(numbers, turns, strict=True)]
    rows += [(500, i, "user", f"turn {i % 7}") for i in range(300)] + [(501, i, "user", f"turn {i % 7}") for i in range(299)] + [(502, 3, "x", "y")] * 4
    rows += [(700 + c, i, "user", t) for c in range(60) for i, t in enumerate(["hi", "there"])]
    return rows


@pytest.mark.parametrize(("chunk", "group"), [(64, 2048), (4, 3), (1, 1)])
def test_prefix_trie(llm, chunk, group):
    rows = made(1)
    own = {}
    for c, turn, role, text in rows:
        own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    df = llm.createDataFrame([(*r, 1, "k") for r in rows], KINDS + ", pos int, conv string").repartition(3)
    turns = prefix_trie.ordered_turns(df)
    ordered = turns.selectExpr("conv", "pos + 1 AS depth", "role", "text")
    convs = turns.groupBy("conv").count().withColumnRenamed("count", "size")
    nodes = prefix_trie.prefix_trie(ordered, convs, chunk, group)
    assert rows_of(nodes) == plain(own)
    if chunk == 64:
        for r in prefix_trie.node_turns(nodes, ordered).collect():
            assert (r.role, r.text) == (own[r.conv_id][r.depth - 1] if r.depth else (None, None))


@pytest.mark.parametrize("seed", [2, 3])
def test_query(llm, tmp_path, seed):
    rows = made(seed)
    llm.createDataFrame(rows, KINDS).write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["op12_prefix_trie"](llm, str(tmp_path))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert rows_of(got) == plain(rebuilt(rows))


def test_turnless_and_empty(llm, tmp_path):
    """A conversation whose first turns are replaced by those of an absent one may have none."""
    single = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6)
    for name, rows in (("one", [(single, 0, "user", "x")]), ("none", [])):
        llm.createDataFrame(rows, KINDS).write.parquet(f"{tmp_path}/{name}/conversations.parquet")
        got = rows_of(QUERIES["op12_prefix_trie"](llm, f"{tmp_path}/{name}"))
        assert got == (plain(rebuilt(rows)) if rows else [])
    assert not rebuilt([(single, 0, "user", "x")])[single]


@needs_tables
def test_query_on_table(llm):
    rows = [tuple(r) for r in llm.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(QUERIES["op12_prefix_trie"](llm, SF)) == plain(rebuilt(rows))
