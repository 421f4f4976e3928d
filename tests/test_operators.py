"""Row numbers, samples, splits, filters, isomers, similarity: against brute force on small data,
with one group holding a large share of the rows."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from qaprep.functions.binding import bind
from qaprep.operators import conversations, filters, indexing, isomers, joins, reactions, sampling, similarity


@pytest.fixture(autouse=True)
def small_slices(monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 40)  # groups beyond 40 rows are cut into slices


@pytest.fixture(scope="module")
def skewed(spark):
    """900 rows; group ``hot`` has a third of them."""
    chance = random.Random(5)
    rows = []
    for i in range(900):
        group = "hot" if i % 3 == 0 else f"g{chance.randrange(60)}"
        rows.append((i, group, f"k{chance.randrange(4)}", f"smi{i}", f"alt{i}", chance.randrange(1000)))
    return spark.createDataFrame(rows, "cid long, formula string, connectivity_key string, smiles string, alt_smiles string, v int")


def test_global_index(skewed):
    got = indexing.global_index(skewed.repartition(7), ["formula", F.desc("v"), "cid"]).select("cid", "row_no").collect()
    wanted = sorted(skewed.collect(), key=lambda r: (r.formula, -r.v, r.cid))
    assert {r.cid: r.row_no for r in got} == {r.cid: i for i, r in enumerate(wanted)}


def test_group_positions_and_top(skewed):
    rows = skewed.collect()
    got = {r.cid: r.member_no for r in indexing.group_positions(skewed, ["formula"], ["cid"]).collect()}
    for group in {r.formula for r in rows}:
        members = sorted(r.cid for r in rows if r.formula == group)
        assert [got[c] for c in members] == list(range(len(members)))
    top = indexing.top_per_group(skewed, ["formula"], [F.desc("v"), F.asc("cid")], 2, F.col("cid"), salts=4).collect()
    for group in {r.formula for r in rows}:
        best = sorted((r for r in rows if r.formula == group), key=lambda r: (-r.v, r.cid))[:2]
        assert {r.cid for r in top if r.formula == group} == {r.cid for r in best}


def test_sliced_join(spark, skewed):
    assert [n for _, n in joins.hot_keys(skewed, ["formula"])] == [8]  # 300 rows of 40
    names = skewed.select("formula").distinct().filter("formula <> 'g1'").withColumn("name", F.upper("formula"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = skewed.join(names, "formula", how)
        sliced = joins.sliced_join(skewed, names, ["formula"], ["cid"], how)
        assert sliced.columns == plain.columns
        assert plain.exceptAll(sliced).isEmpty() and sliced.exceptAll(plain).isEmpty()
    repeated = filters.duplicate_groups(skewed.select("cid", "formula"), "formula", "cid")
    assert repeated.count() == skewed.join(skewed.groupBy("formula").count().filter("count > 1"), "formula").count()


def test_first_rows_both_ways(skewed, monkeypatch):
    few = {r.cid for r in indexing.first_rows(skewed, ["v", "cid"], 50).collect()}
    monkeypatch.setattr(indexing, "TOP_K_ROWS", 10)
    assert {r.cid for r in indexing.first_rows(skewed, ["v", "cid"], 50).collect()} == few and len(few) == 50


def test_sample_and_splits(spark, skewed):
    for n in (0, 1, 37, 900, 5000):
        assert sampling.seeded_sample(skewed, "cid", n).count() == min(n, 900)
    a = {r.cid for r in sampling.seeded_sample(skewed, "cid", 100).collect()}
    assert a == {r.cid for r in sampling.seeded_sample(skewed.repartition(9), "cid", 100).collect()}
    assert a != {r.cid for r in sampling.seeded_sample(skewed, "cid", 100, seed=1).collect()}
    big = spark.range(40000).withColumnRenamed("id", "cid")
    drawn = sampling.assign_splits(big, "cid", 0.1, 0.05)
    counts = {r.split: r.n_rows for r in sampling.split_counts(drawn).collect()}
    assert abs(counts["valid"] / 40000 - 0.1) < 0.01 and abs(counts["test"] / 40000 - 0.05) < 0.01
    again = sampling.assign_splits(big.repartition(13), "cid", 0.1, 0.05)
    assert drawn.exceptAll(again).isEmpty()
    with pytest.raises(ValueError):
        sampling.assign_splits(big, "cid", 0.5, 0.5)
    with pytest.raises(ValueError):
        sampling.random_partition(big, "cid", {"a": 0.5, "b": 0.4})
    frames = sampling.split_by_column(spark.createDataFrame([(1, "train"), (2, "test"), (3, "other")], "i int, split string"))
    assert {k: v.columns for k, v in frames.items()} == {"train": ["i"], "test": ["i"]}


def test_filters(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, "x", None), (3, " ", 9.0)], "a int, b string, c double")
    assert filters.drop_null_columns(df).columns == ["a"]
    assert filters.drop_null_columns(df, keep=["b"]).columns == ["a", "b"]
    assert [r.a for r in filters.range_filter(df, "c", 2, None).collect()] == [1, 3]
    assert filters.range_filter(df, "missing").columns == df.columns
    with pytest.raises(ValueError):
        filters.range_filter(df, "missing", 1)
    assert [r.a for r in filters.nonblank(df, "b").collect()] == [2]
    assert [r.a for r in filters.not_empty(df, "b").collect()] == [2, 3]
    moved = filters.replace_answers(df, {"b": F.lit("new"), "d": F.col("b")}, F.col("a") > 1)
    assert moved.columns == ["a", "c", "b", "d"] and [tuple(r) for r in moved.collect()] == [(2, None, "new", "x"), (3, 9.0, "new", " ")]


def isomer_table(rows):
    return {
        r.cid: {o.cid for o in rows if o.formula == r.formula and o.connectivity_key != r.connectivity_key} for r in rows
    }


def test_isomers(skewed):
    rows = skewed.collect()
    partners = isomer_table(rows)
    counts = {r.cid: r.n_isomers for r in isomers.isomer_pairs(skewed).collect()}
    assert counts == {c: len(p) for c, p in partners.items() if p}
    by_cid = {r.cid: r for r in rows}
    got = isomers.isomer_questions(skewed).collect()
    assert {q.cid for q in got} == set(counts)
    for q in got:
        options = [q.smiles_A, q.smiles_B, q.smiles_C, q.smiles_D]
        right = by_cid[q.cid].alt_smiles
        assert options.count(right) == 1 and options["ABCD".index(q.isomer_answer)] == right
        assert q.kekulized_smiles == by_cid[q.cid].smiles
        decoys = [o for o in options if o != right]
        used = {int(o[3:]) for o in decoys}
        assert used <= partners[q.cid]
        if len(partners[q.cid]) >= 3:
            assert len(used) == 3 and all(o.startswith("smi") for o in decoys)
        else:
            assert used == partners[q.cid]
    again = isomers.isomer_questions(skewed.repartition(5)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_isomer_draws_are_spread(spark):
    rows = [(i, "f", "k0" if i == 0 else f"k{i}", "s", "a") for i in range(11)]
    df = spark.createDataFrame(rows, "cid long, formula string, connectivity_key string, smiles string, alt_smiles string")
    seen = set()
    for seed in range(8):
        numbered, draws = isomers.sample_candidates(df, seed=seed)
        names = {r["_no"]: r.cid for r in numbered.collect()}
        seen |= {names[r.candidate] for r in draws.collect() if r.cid == 0}
    assert 0 not in seen and len(seen) >= 8


def fingerprints(n, seed, bits=60):
    """Random bit sets in families of near copies, a third of them equal, some empty."""
    chance = random.Random(seed)
    families = [sorted(chance.sample(range(bits), chance.randrange(4, 20))) for _ in range(12)]
    out = []
    for i in range(n):
        if i % 3 == 0:
            out.append((i, 10, families[0]))
        elif i % 29 == 0:
            out.append((i, 10, []))
        else:
            base = set(chance.choice(families))
            base ^= set(chance.sample(range(bits), chance.randrange(0, 6)))
            out.append((i, chance.randrange(5, 30), sorted(base)))
    return out


def similarity_of(a, b):
    both = len(set(a) & set(b))
    total = len(a) + len(b) - both
    return both / total if total else 0.0


@pytest.mark.parametrize("hot_rows,small", [(50_000, 200_000), (50_000, 0), (7, 0)])
def test_similarity_join(spark, monkeypatch, hot_rows, small):
    monkeypatch.setattr(similarity, "HOT_ROWS", hot_rows)  # 7: every common bit is cut into slices
    monkeypatch.setattr(similarity, "BROADCAST_ROWS", small)  # 0: both sides are shuffled
    rows = fingerprints(240, 3)
    df = spark.createDataFrame(rows, "id long, size int, bits array<int>")
    for threshold in (0.3, 0.6, 0.9):
        got = {(r.id_a, r.id_b): (r.n_a, r.n_b, round(r.similarity, 9)) for r in similarity.similarity_join(df, "id", "bits", threshold).collect()}
        groups = {}
        for i, _, b in rows:
            if b:
                groups.setdefault(tuple(b), []).append(i)
        wanted = {(m[0], m[0]): (len(m), len(m), 1.0) for m in groups.values() if len(m) > 1}
        for (a, ma), (b, mb) in itertools.combinations(sorted(groups.items(), key=lambda g: g[1][0]), 2):
            if similarity_of(a, b) >= threshold:
                wanted[ma[0], mb[0]] = (len(ma), len(mb), round(similarity_of(a, b), 9))
        assert got == wanted


def scan_picks(rows, distance):
    picks = []
    for i, _, bits in rows:
        if all(1.0 - similarity_of(bits, b) > distance for _, b in picks):
            picks.append((i, bits))
    return {i for i, _ in picks}


@pytest.mark.parametrize("first_chunk,small", [(8192, 0), (16, 0), (16, 200_000)])
def test_leader_pick(spark, monkeypatch, first_chunk, small):
    monkeypatch.setattr(similarity, "BROADCAST_ROWS", small)
    monkeypatch.setattr(similarity, "FIRST_CHUNK", first_chunk)  # 16: several chunks
    rows = fingerprints(200, 11)
    df = spark.createDataFrame(rows, "id long, size int, bits array<int>")
    got = {r.id for r in similarity.leader_pick(df, "id", "bits", 0.5).collect()}
    assert got == scan_picks(rows, 0.5)


def test_leaders_of_long_chains(spark, monkeypatch):
    """Rows that are near their neighbours only: one block resolves a chain of any length at once, and
    small blocks need no more rounds than there are blocks."""
    monkeypatch.setattr(similarity, "BLOCK_EDGES", 40)
    rows = [(i, 3, list(range(10 * i, 10 * i + 20))) for i in range(150)]  # two neighbours share a third
    df = spark.createDataFrame(rows, "id long, size int, bits array<int>").repartition(3)
    rounds, scan = [], similarity.write_through
    monkeypatch.setattr(similarity, "write_through", lambda d, label: (rounds.append(label), scan(d, label))[1])
    got = {r.id for r in similarity.leader_pick(df, "id", "bits", 0.7).collect()}
    assert got == scan_picks(rows, 0.7) == set(range(0, 150, 2))
    assert rounds.count("gone") <= 2 * -(-149 // 40) + 2
    monkeypatch.setattr(similarity, "BLOCK_EDGES", 1_000_000)
    rounds.clear()
    assert {r.id for r in similarity.leader_pick(df, "id", "bits", 0.7).collect()} == set(range(0, 150, 2))
    assert rounds.count("gone") <= 2


def test_keys_of_similar_rows(spark):
    """Bits that the same rows have are one key, and far fewer rows meet than there are pairs."""
    df = spark.createDataFrame([(i, [1, 2, 3, 100 + i % 7, 200 + i, 300 + i]) for i in range(60)], "id long, bits array<int>")
    prints, (ranks, heads) = similarity.distinct_prints(df, "id", "bits")
    assert sorted(ranks.values()) == list(range(len(ranks))) and len(heads) == 1 + 7 + 60
    assert {ranks[1], ranks[2], ranks[3]} == {len(ranks) - 3, len(ranks) - 2, len(ranks) - 1} or ranks[2] - ranks[1] == 1
    assert all(k.left == r.n_bits - r.bits.index(k.bit) and k.bit in heads for r in prints.collect() for k in r["keys"])


@pytest.mark.parametrize("first_chunk,hot_rows", [(8192, 50_000), (16, 9)])
def test_similar_join(spark, monkeypatch, first_chunk, hot_rows):
    monkeypatch.setattr(similarity, "FIRST_CHUNK", first_chunk)
    monkeypatch.setattr(similarity, "HOT_ROWS", hot_rows)
    monkeypatch.setattr(similarity, "BROADCAST_ROWS", 0 if hot_rows == 9 else 200_000)
    rows = fingerprints(200, 17)
    df = spark.createDataFrame(rows, "id long, size int, bits array<int>")
    chosen = [i for i, _, _ in rows if i % 5 == 1]
    picks = spark.createDataFrame([(i,) for i in chosen], "id long")
    by_id = {i: (s, b) for i, s, b in rows}
    wanted = {}
    for i in chosen:
        size, bits = by_id[i]
        fit = [j for j, (s, b) in by_id.items() if j != i and size * 0.83 <= s <= size * 1.17 and 0.45 <= similarity_of(bits, b) < 0.65]
        if fit:
            wanted[i] = min(fit)
    got = {r.id: r.similar_id for r in similarity.similar_join(df, picks, "id", "bits", "size").collect()}
    assert got == wanted and wanted
    merged = {r.id for r in similarity.merge_picks(picks, similarity.similar_join(df, picks, "id", "bits", "size"), "id").collect()}
    assert merged == set(chosen) | set(wanted.values())


def test_tanimoto_of_empty_sets(spark):
    df = spark.createDataFrame([([], []), ([1], []), ([1, 2], [2, 3])], "a array<int>, b array<int>")
    assert [round(r.t, 6) for r in df.select(similarity.tanimoto(F.col("a"), F.col("b")).alias("t")).collect()] == [0.0, 0.0, round(1 / 3, 6)]


def test_reactions(spark):
    lines = ["[CH3:1]O.C.C>>CO", "C.[CH3]O>>CO", "C>O", "A>B>C extra", "N.O>[Na+:3]>N"]
    df = spark.createDataFrame(list(enumerate(lines)), "no long, value string")
    parsed = reactions.parse_reactions(df)
    assert {r.no: (r.reactants, r.agents, r.products) for r in parsed.collect()} == {
        0: (["C", "[CH3]O"], [], ["CO"]), 1: (["C", "[CH3]O"], [], ["CO"]), 4: (["N", "O"], ["[Na+]"], ["N"]),
    }
    assert sorted(r.no for r in reactions.reaction_dedup(parsed, "no").collect()) == [0, 4]
    assert [r.no for r in reactions.reaction_dedup(parsed, "no", limit=1).collect()] == [0]


def test_chat_context(spark, monkeypatch):
    monkeypatch.setattr(conversations, "CHUNK", 8)  # one conversation spans many chunks
    rows = [(1, t, f"a{t}") for t in range(0, 90, 2)] + [(2, 0, "b0"), (2, 2, "b2")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    got = {(r.conv_id, r.turn): r.context for r in conversations.chat_context(df).collect()}
    for conv, turn, _ in rows:
        earlier = [t for c, n, t in rows if c == conv and n <= turn][-5:]
        assert got[conv, turn] == " ".join(f"User: {t}" for t in earlier)
    alone = conversations.chat_context(df, history=False).filter("conv_id = 2 AND turn = 2").first()
    assert alone.context == "b2"


def test_chat_context_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(conversations, "CHUNK", 4)
    df = spark.createDataFrame([(1, t, f"t{t}") for t in range(30)], "conv_id int, turn int, text string")
    got = {r.turn: r.context for r in conversations.chat_context(df, last=10).collect()}
    assert got == {t: " ".join(f"User: t{i}" for i in range(max(0, t - 9), t + 1)) for t in range(30)}


def test_bind(spark):
    df = spark.createDataFrame([(3,)], "a int")
    assert df.select(bind(F.col("a") + 1, lambda v: v * v).alias("x")).first().x == 16


def test_similarity_join_moves_pairs_once(spark):
    """The counts travel with the prefix rows: no join but the one that finds the pairs."""
    df = spark.createDataFrame(fingerprints(60, 3), "id long, size int, bits array<int>")
    plan = similarity.similarity_join(df, "id", "bits", 0.6)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Join ") == 1


def test_similar_pairs_block_by_block(spark, monkeypatch):
    """Keys that many rows have are cut into blocks on both sides, and pairs are counted in tiles, not one by one in a join."""
    for name, value in (("BLOCK_ROWS", 5), ("TILE", (3, 4)), ("PAIRS_AT_ONCE", 10)):
        monkeypatch.setattr(similarity, name, value, raising=False)
    rows = [(i, b) for i, _, b in fingerprints(260, 23)] + [(1000 + i, list(range(i % 40))) for i in range(2, 60)]  # equal sizes and subsets of one another
    df = spark.createDataFrame(rows, "id long, bits array<int>").repartition(3)
    by_bits = {}
    for i, b in rows:
        if b:
            by_bits.setdefault(tuple(b), []).append(i)
    for threshold in (0.45, 0.7):
        prints, _ = similarity.distinct_prints(df, "id", "bits")
        pairs = similarity.similar_pairs(prints, threshold, "n_rows")
        assert "bit_count" not in pairs._jdf.queryExecution().analyzed().toString()
        wanted = set()
        for (a, ma), (b, mb) in itertools.combinations(sorted(by_bits.items(), key=lambda g: min(g[1])), 2):
            if similarity_of(a, b) >= threshold:
                wanted.add((min(ma), min(mb), len(set(a) & set(b)), len(a), len(b), len(ma), len(mb)))
        got = [tuple(r) for r in pairs.select("id_a", "id_b", "shared", "n_bits_a", "n_bits_b", "n_rows_a", "n_rows_b").collect()]
        assert len(got) == len(wanted) and set(got) == wanted


def test_fingerprint_by_brute_force(spark):
    """Runs of characters beyond the basic plane, repeated, null and empty texts; worked out in batches, not per character."""
    import hashlib

    from pyspark.sql import functions as F

    texts = [None, "", "a", "aé😀b\x00c😀", "aaaa", "x y" * 700] * 90
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(2)
    out = df.select("i", similarity.fingerprint(F.col("t")).alias("bits"))
    of = lambda t: sorted({int(hashlib.md5(t[i : i + n].encode()).hexdigest()[:8], 16) % 2048 for n in (1, 2, 3) for i in range(len(t) - n + 1)})
    wanted = {t: None if t is None else of(t) for t in set(texts)}
    assert all(r.bits == wanted[texts[r.i]] for r in out.collect())
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()
