"""Bin completion against the best packing of small cases, and the query against the library."""

import random
import zlib

import numpy as np
import pytest
from llm_cases import SF, needs_tables

from qaprep.llm import bin_completion
from qaprep.llm.packing import unpack
from qaprep.llm.queries import QUERIES


def fewest(sizes, room):
    """The fewest bins, over all orders: for each set of sizes the fewest bins and the least filled last one."""
    best = [(1, 0)] + [(len(sizes) + 2, 0)] * ((1 << len(sizes)) - 1)
    for some in range(1, len(best)):
        for i in (i for i in range(len(sizes)) if some >> i & 1):
            bins, filled = best[some ^ (1 << i)]
            best[some] = min(best[some], (bins, filled + sizes[i]) if filled + sizes[i] <= room else (bins + 1, sizes[i]))
    return best[-1][0] if sizes else 0


def test_complete_is_optimal_on_small_cases():
    rng, gained = random.Random(1), 0
    for _ in range(250):
        room = rng.choice([10, 20, 50, 100])
        low, high = rng.choice([(0.0, 0.3), (0.0, 0.9), (0.18, 0.55)])
        sizes = [rng.randint(1 + int(low * room), max(1, int(high * room))) for _ in range(rng.randint(0, 10))]
        if room >= 50 and rng.random() < 0.4:  # three full bins of three or four pieces
            sizes = []
            for _ in range(3):
                a, b = rng.randint(room // 5, room // 2), rng.randint(room // 5, room // 3)
                sizes += [a, b, room - a - b]
        bins = bin_completion.complete(sizes, room, nodes=10**6, width=10**6, steps=10**6)
        assert sorted(s for b in bins for s in b) == sorted(sizes) and all(sum(b) <= room for b in bins)
        want = fewest(sizes, room)
        assert len(bins) == want
        assert bin_completion.lower_bound(np.bincount(np.array(sizes, dtype=int), minlength=room + 1), room) <= want
        gained += len(bin_completion.best_fit_decreasing(sizes, room)) > want
    assert gained  # the search does better than its first incumbent


def test_limits_give_whole_packings():
    rng = random.Random(2)
    for low, high, n in ((650, 700, 600), (300, 2000, 500), (2, 500, 900), (1025, 1100, 50)):
        sizes = [rng.randint(low, high) for _ in range(n)]
        bins, first = bin_completion.complete(sizes, 2048), bin_completion.best_fit_decreasing(sizes, 2048)
        assert sorted(s for b in bins for s in b) == sorted(sizes) and all(sum(b) <= 2048 for b in bins)
        assert len(bins) <= len(first)
    assert len(bin_completion.complete([650 + i % 50 for i in range(600)], 2048)) <= len(bin_completion.best_fit_decreasing([650 + i % 50 for i in range(600)], 2048))


def test_best_fit_decreasing():
    sizes, room = [random.Random(3).randint(1, 60) for _ in range(200)], 100
    bins: list[list[int]] = []
    for size in sorted(sizes, reverse=True):
        fits = [b for b in bins if sum(b) + size <= room]
        max(fits, key=sum).append(size) if fits else bins.append([size])
    assert sorted(map(sum, bins)) == sorted(map(sum, bin_completion.best_fit_decreasing(sizes, room)))


def test_dominated():
    counts = {60: 1, 50: 1, 40: 1, 20: 2, 10: 1}
    every = lambda left, waste: bin_completion.fillings(counts, left, waste, 10**6, 10**6)[0]
    assert every(60, 60) == [(60,)]  # stands for 40 + 20, 50 + 10 and 20 + 20 + 10
    assert every(45, 45) == [(40,)]
    assert every(70, 0) == [(60, 10), (50, 20)]
    assert every(5, 4) == [] and every(5, 5) == [()]


@pytest.mark.parametrize("group", [8, 16384])
def test_pack_whole(llm, vocab, edge_docs, edge_rows, group):
    from tokenizers import Tokenizer

    rows = bin_completion.pack_whole(edge_docs, vocab.path("word_bpe_49k.json"), length=64, group=group).collect()
    tokenizer = Tokenizer.from_file(vocab.path("word_bpe_49k.json"))
    sequences, whole = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
        whole.setdefault(r.doc_id, []).append(r)
        assert r.length == len(unpack(r.ids)) and r.start == 64 * r.piece
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= 64
    wanted = {}
    for i, t in edge_rows:
        wanted.setdefault(i, []).append([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0])
    for i, texts in wanted.items():
        want = sorted((n, tuple(ids[at : at + 64])) for ids in texts for n, at in enumerate(range(0, len(ids), 64)))
        assert sorted((r.piece, tuple(unpack(r.ids))) for r in whole[i]) == want
    bound = bin_completion.lower_bound(np.bincount([r.length for r in rows], minlength=65), 64)
    assert len(sequences) <= bound + (1 if group > 100 else 4)


def test_wide_ids(llm, vocab, edge_docs, edge_rows):
    """An end id beyond 16 bits makes all ids wide."""
    rows = bin_completion.pack_whole(edge_docs, vocab.path("word_bpe_49k.json"), end_id=70_000).collect()
    assert sum(unpack(r.ids).count(70_000) for r in rows) == len(edge_rows) and all(r.length == len(unpack(r.ids)) for r in rows)


def test_empty(llm, vocab, no_docs):
    assert bin_completion.pack_whole(no_docs, vocab.path("word_bpe_49k.json")).count() == 0


@needs_tables
def test_query(llm, vocab):
    from tokenizers import Tokenizer

    got = QUERIES["op11_bin_completion"](llm, SF)
    assert got.columns[:7] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    tokenizer = Tokenizer.from_file(vocab.path("word_bpe_49k.json"))
    want = []
    for r in llm.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        want += [(r.doc_id, n, at, len(ids[at : at + 2048]), zlib.crc32(np.array(ids[at : at + 2048], dtype="<u4").tobytes())) for n, at in enumerate(range(0, len(ids), 2048))]
    rows = got.collect()
    assert sorted(tuple(r)[:5] for r in rows) == sorted(want)
    filled = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all([o for o, _ in sorted(p)] == [sum(n for _, n in sorted(p)[:i]) for i in range(len(p))] and sum(n for _, n in p) <= 2048 for p in filled.values())
    assert len(filled) == bin_completion.lower_bound(np.bincount([r.length for r in rows], minlength=2049), 2048)
