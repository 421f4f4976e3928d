"""Periodic runs against a plain search."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from llm_cases import SF, needs_tables

from qaprep.llm import period_runs
from qaprep.llm.queries import QUERIES


def plain_runs(words, least=24):
    """All maximal stretches by every lag, the smallest period of each."""
    found = {}
    n = len(words)
    for q in range(1, n // 3 + 1):
        t = 0
        while t + q < n:
            if words[t] != words[t + q]:
                t += 1
                continue
            s = t
            while t + q < n and words[t] == words[t + q]:
                t += 1
            if t - s + q >= max(least, 3 * q):
                found.setdefault((s, t + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapse(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(seed):
    """Texts of few and of many words with runs of any period, nested, touching and broken ones."""
    rng = random.Random(seed)
    words: list[str] = []
    for _ in range(rng.randint(1, 5)):
        words += [f"w{rng.randint(0, rng.choice([1, 3, 400]))}" for _ in range(rng.randint(0, 120))]
        block = [f"w{rng.randint(0, rng.choice([0, 1, 5, 900]))}" for _ in range(rng.choice([1, 2, 5, 30, 47, 48, 49, 70, 71, 72, 100, 161, 230]))]
        if rng.random() < 0.5:  # a period made of shorter runs
            inner = block[: rng.randint(1, 9)]
            block = inner * rng.randint(1, 40) + block
        copies = block * rng.randint(2, 5)
        copies = copies[: len(copies) - rng.randint(0, len(block))]
        if rng.random() < 0.2 and copies:
            copies[rng.randrange(len(copies))] = "odd"
        words += copies
    return words


@pytest.mark.parametrize("part", range(4))
def test_against_plain_search(part):
    texts = [planted(1000 * part + i) for i in range(40)] + [["x"] * 500, ["a", "b"] * 300, [], ["one"], [f"u{i}" for i in range(700)]]
    _, numbers, lengths = period_runs._numbered([" ".join(t).encode() for t in texts])
    for short in (48, 64):
        got = period_runs.find_runs(numbers, lengths, short=short)
        base, want = 0, []
        for t in texts:
            want += [(base + s, base + s + length, q) for s, length, q in plain_runs(t)]
            base += len(t)
        assert got == sorted(want)


def test_hard_words():
    """Fibonacci and Thue-Morse words, which hold as many repetitions as can be; all gram hashes alike."""
    fib, more = ["a"], ["a", "b"]
    while len(more) < 1500:
        fib, more = more, more + fib
    thue = [str(bin(i).count("1") & 1) for i in range(2048)]
    for words in (more, thue, thue[:333] * 4, (more[:150] + ["c"]) * 5):
        _, numbers, lengths = period_runs._numbered([" ".join(words).encode()])
        assert [(s, e - s, q) for s, e, q in period_runs.find_runs(numbers, lengths)] == plain_runs(words)


def test_sliding():
    values = np.random.default_rng(1).integers(0, 1 << 60, 300).astype(np.uint64)
    for width in (1, 2, 3, 7, 64, 100, 300):
        assert period_runs.sliding_least(values, width).tolist() == [min(values[i : i + width]) for i in range(301 - width)]
        assert period_runs.sliding_greatest(values, width).tolist() == [max(values[i : i + width]) for i in range(301 - width)]


def test_rows(llm, edge_docs, edge_rows, no_docs):
    got = sorted((r.doc_id or 0, r.n_words, tuple(tuple(x) for x in r.runs), r.collapsed) for r in period_runs.periodic_runs(edge_docs).collect())
    want = []
    for i, t in edge_rows:
        words = [w.decode() for w in (t or "").encode().split()]
        runs = plain_runs(words) if len(words) < 500 else []
        want.append((i or 0, len(words), tuple(runs), collapse(words, runs)))
    assert got == sorted(want)
    assert period_runs.periodic_runs(no_docs).count() == 0


def query_row(doc_id, text):
    """The row the query gives, by the definition."""
    words = [w.decode() for w in (text or "").encode().split()]
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *best, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(collapse(words, runs)))


def check_query(llm, docs, folder):
    docs.write.parquet(f"{folder}/documents.parquet")
    got = QUERIES["op13_period_runs"](llm, str(folder))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    order = lambda r: str(r)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got.collect()), key=order) == sorted((query_row(*r) for r in rows), key=order)


def test_query(llm, tmp_path):
    rows = [(i, " ".join(planted(i)) if i % 4 else " ".join(f"v{j}" for j in range(i))) for i in range(300)]
    rows += [(None, "a b c d e f g h"), (None, None), (7, ""), (7, " \t"), (8, "x " * 90), (8, "x " * 90), (9, "a b\n" * 20 + "c " * 30)]
    check_query(llm, llm.createDataFrame(rows, "doc_id bigint, text string").withColumnRenamed("x", "y"), tmp_path)


@needs_tables
def test_query_on_documents(llm, tmp_path):
    docs = llm.read.parquet(f"{SF}/documents.parquet").filter("size(split(text, ' ')) < 1500 OR text IS NULL")
    check_query(llm, docs, tmp_path)


def test_empty_query(llm, no_docs, tmp_path):
    check_query(llm, no_docs, tmp_path)
