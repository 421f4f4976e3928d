"""Toxicity, language and language-model scores: planted signals, edge cases, and sums by brute force."""

import math
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from qaprep.llm import language_id, lm_scoring, toxicity

LANGS = {
    "en": "the of and to in that was with his they this have from word which said there".split(),
    "de": "der die und das nicht ein sich auch nach bei wie über einen schön größe werden".split(),
    "fr": "le la les et des une dans qui pour pas sur être français où très avec".split(),
}


def text_in(lang, seed, words=40):
    rng = random.Random(f"{lang}{seed}")
    return " ".join(rng.choice(LANGS[lang]) for _ in range(words)) + "."


@pytest.fixture(scope="module")
def toxic_rows():
    rng = random.Random(1)
    rows = []
    for i in range(400):
        sentences = [text_in("en", f"{i}-{j}", 8) for j in range(rng.randint(2, 6))]
        bad = i % 4 == 0
        if bad:
            at = rng.randrange(len(sentences))
            sentences[at] = sentences[at][:-1] + " " + rng.choice(["scoundrel", "villainous", "wretch"]) + "."
        rows.append((i, " ".join(sentences), int(bad)))
    return rows


def test_toxicity_finds_documents_and_sentences(llm, toxic_rows):
    docs = llm.createDataFrame([r[:2] for r in toxic_rows], "doc_id bigint, text string")
    labels = llm.createDataFrame([(i, y, 9) for i, _, y in toxic_rows] + [(None, 1, 0), (9999, None, 0), (5000, 1, 0)], "doc_id bigint, toxic int, quality int")
    model = toxicity.train(docs, labels, F.col("doc_id") % 5 != 0)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [(i, t, y) for i, t, y in toxic_rows if i % 5 == 0]
    assert all((got[i].score >= 0.5) == bool(y) for i, _, y in held)
    for i, text, y in held:
        for s in got[i].sentences:
            assert any(w in text.encode()[s.start : s.end].decode() for w in ("scoundrel", "villainous", "wretch"))
        assert bool(got[i].sentences) == bool(y)
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == ["doc_id", "text"] and {r.doc_id for r in kept.collect()} == {i for i, _, _ in toxic_rows if got[i].score < 0.5}


def test_toxicity_edge_cases(llm, edge_docs, edge_rows, no_docs):
    labels = llm.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.train(edge_docs, labels, F.lit(True))
    rows = toxicity.score(edge_docs, model).collect()
    assert len(rows) == len(edge_rows) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert toxicity.score(no_docs, model).count() == 0 and toxicity.drop_toxic(no_docs, model).columns == no_docs.columns
    assert toxicity.drop_toxic(edge_docs, model).columns == edge_docs.columns


def test_noisy_or_gradient():
    """The fit's step direction against a numeric derivative, by the loss going down."""
    slots, sentence_of, doc_of = np.array([1, 2, 3, 1, 4, 5]), np.array([0, 0, 1, 2, 3, 3]), np.array([0, 0, 1, 2])
    labels = np.array([1, 1, 0])

    def loss(model):
        z = np.bincount(sentence_of, weights=model.weights[slots], minlength=4) + model.bias
        p = np.clip(-np.expm1(np.bincount(doc_of, weights=-np.logaddexp(0, z), minlength=3)), 1e-9, 1 - 1e-9)
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    assert loss(toxicity.fit(slots, sentence_of, doc_of, labels, rounds=60)) < loss(toxicity.fit(slots, sentence_of, doc_of, labels, rounds=1))


def test_forward_backward_against_all_labellings():
    from itertools import product

    rng = np.random.default_rng(0)
    scores, move, start = rng.normal(size=(2, 4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    lengths = np.array([4, 2])
    marginal, expected = language_id.forward_backward(scores, lengths, move, start, pairs=True)
    want_pairs = np.zeros((3, 3))
    for c, n in enumerate(lengths):
        weights = {p: math.exp(start[p[0]] + sum(scores[c, t, p[t]] for t in range(n)) + sum(move[p[t], p[t + 1]] for t in range(n - 1))) for p in product(range(3), repeat=int(n))}
        total = sum(weights.values())
        for t in range(n):
            for y in range(3):
                assert marginal[c, t, y] == pytest.approx(sum(w for p, w in weights.items() if p[t] == y) / total)
        for p, w in weights.items():
            for t in range(n - 1):
                want_pairs[p[t], p[t + 1]] += w / total
    assert np.allclose(expected, want_pairs)
    assert marginal[1, 2:].sum() == 0


def test_language(llm):
    rows = [(i, text_in(lang, i), lang) for i, lang in enumerate(list(LANGS) * 40)] + [(900, "words", None), (901, None, "en")]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.train(docs, F.col("doc_id") % 4 != 2)
    got = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    assert all(got[i].lang_pred == lang and 0.5 < got[i].score <= 1 for i, _, lang in rows[:120] if i % 4 == 2)
    mixed = text_in("en", 7, 15) + " " + text_in("de", 8, 15)
    odd = llm.createDataFrame([(1, mixed), (2, None), (3, ""), (4, "12 34 !! ..."), (4, "12 34 !! ..."), (None, text_in("fr", 3))], "doc_id bigint, text string")
    rows = language_id.predict(odd, model).collect()
    found = {r.doc_id: r for r in rows}
    assert len(rows) == 6 and [r.lang for r in found[1].runs][:1] == ["en"] and [r.lang for r in found[1].runs][-1:] == ["de"]
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (2, 3, 4)) and found[None].lang_pred == "fr"


def test_language_without_anything_to_learn(edge_docs, edge_rows, no_docs):
    model = language_id.train(edge_docs, F.lit(False))
    rows = language_id.predict(edge_docs, model).collect()
    assert len(rows) == len(edge_rows) and {r.lang_pred for r in rows} == {"und"}
    assert language_id.predict(no_docs, model).count() == 0


def test_language_every_label_is_learned(llm):
    names = [f"l{i:02d}" for i in range(70)]
    rows = [(i * 10 + j, f"{chr(0x4E00 + i) * 3} {chr(0x4E00 + i) * 4}", name) for i, name in enumerate(names) for j in range(3 if i < 64 else 2)]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language_id.predict(docs, language_id.train(docs, F.lit(True), rounds=10), runs=False).collect()}
    assert got == {i: name for i, _, name in rows}


def test_language_unspaced_text_is_read_whole(llm):
    """Lines without blanks that differ in their middle only, and one that changes its language there."""
    middle = {"xa": "丁丂七" * 12, "xb": "币市布" * 12}
    edge = "渁渂渃渄" * 8
    rows = [(i, edge + middle[x] + edge, x) for i, x in enumerate(["xa", "xb"] * 20)]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.train(docs, F.lit(True))
    asked = llm.createDataFrame([(i, t) for i, t, _ in rows[:2]] + [(9, middle["xa"] * 3 + middle["xb"] * 3)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in language_id.predict(asked, model).collect()}
    assert [got[i].lang_pred for i in (0, 1)] == ["xa", "xb"] and [r.lang for r in got[9].runs] == ["xa", "xb"]


def test_lm_sums(llm, vocab, edge_docs, edge_rows, monkeypatch):
    """Base scores, counts and known tokens against brute force, with few words travelling (the rest is joined)."""
    path = vocab.path("byte_bpe_50k.tiktoken")
    training = F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False))
    counts, documents = Counter(), 0
    for i, t in edge_rows:
        if i is not None and i % 2 == 0:
            counts.update(lm_scoring.words_of((t or "").encode()))
            documents += 1
    n, v = sum(counts.values()) + documents, len(counts) + 1
    for frequent in (20, 1 << 18):
        rows = lm_scoring.score_texts(edge_docs, training, path, vocab.PATTERN, steps=5, sample=10, frequent=frequent).collect()
        got = sorted(((r.doc_id or 0), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
        want = []
        for i, t in edge_rows:
            cs = [counts[w] for w in lm_scoring.words_of((t or "").encode())] + [documents]
            want.append(((i or 0), len(cs), sum(c > 0 for c in cs), n, round(sum(math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in cs), 6)))
        assert got == sorted(want)
        assert all(r.score <= 0 and math.isfinite(r.score) for r in rows)


def test_lm_probabilities_sum_to_one():
    """Over all continuations of a context, and windows score each place once with the text before it."""
    rng = np.random.default_rng(1)
    count, starts = 9, np.array([1, 1, 0, 1, 0, 1, 0, 0, 1], dtype=bool)
    model = lm_scoring.Attention(count, starts)
    for name, value in model.p.items():
        noise = rng.normal(size=value.shape).astype(np.float32)
        model.p[name] = value + noise if name == "inner_before" else noise
    classes = rng.integers(3, count, 100)
    lengths = np.array([60, 0, 40])[[0, 2]]
    source, there, target = lm_scoring.windows(lengths)
    assert sorted(target[target >= 0].tolist()) == list(range(100))
    padded = np.r_[classes, 0]
    total = 0
    for y in range(count):
        log_p, log_start = model.log_probabilities(padded[source], there, np.full_like(target, y))
        total = total + np.exp(log_p)
        if y == 0:
            start = np.exp(log_start)
    assert np.allclose(total, 1, atol=1e-5) and (start < 1).all()
    changed = classes.copy()
    changed[30] = 3 if classes[30] != 3 else 4  # what comes later changes nothing before
    score = lambda c: model.log_probabilities(np.r_[c, 0][source], there, np.zeros_like(target))[0][target >= 0]
    order = np.argsort(target[target >= 0])
    same = np.isclose(score(classes)[order], score(changed)[order], atol=1e-5)
    assert same[:31].all() and same[60:].all() and not same[31:40].all()


def test_lm_forward_is_lean():
    """The same probabilities as from every row's own greatest logit, also where rows lie far apart, in less time than
    attending and the logits took alone."""
    rng = np.random.default_rng(4)
    count = 200
    starts = rng.random(count) < 0.5
    starts[0] = True
    model = lm_scoring.Attention(count, starts)
    for name, value in model.p.items():
        model.p[name] = value + rng.normal(size=value.shape).astype(np.float32)
    lengths = np.array([3000, 1, 29, 3000])
    source, there, target = lm_scoring.windows(lengths)
    padded = np.r_[rng.integers(0, count, lengths.sum()), 0]
    ids, goal = padded[source], padded[target]

    def plain():
        mixed, (asking, *_) = model.attend(ids, there)
        return model._logits(mixed, asking, goal)

    for far in (0, 300):  # logits of some classes before are shifted as a whole, which changes no probability
        model.p["before"][::3] -= far
        outer, inner, group, _ = plain()
        log_sum = lambda x: np.log(np.exp(x - x.max(axis=1, keepdims=True)).sum(axis=1)) + x.max(axis=1)
        row, word = np.arange(len(outer)), np.where(model.start_group, outer, -np.inf)
        want = outer[row, group] - log_sum(outer) + inner[row, model.place[goal.ravel()]] - log_sum(inner)
        log_p, log_start = model.log_probabilities(ids, there, goal)
        assert np.allclose(log_p.ravel(), want, atol=2e-3) and np.allclose(log_start.ravel(), log_sum(word) - log_sum(outer), atol=2e-3)

    def least(run):
        times = []
        for _ in range(7):
            began = time.process_time()
            run()
            times.append(time.process_time() - began)
        return min(times)

    model.p["before"][::3] += far
    assert least(lambda: model.log_probabilities(ids, there, goal)) < least(plain)


def test_lm_numbers(vocab, monkeypatch):
    """Words have the ids the encoder gives them, over calls, growth and clearing; a word is hashed only where that is wanted."""
    path, hashed, plain = vocab.path("byte_bpe_50k.tiktoken"), [], lm_scoring._hash
    size = max(lm_scoring.load_ranks(path).values()) + 1
    monkeypatch.setattr(lm_scoring, "_hash", lambda w: (hashed.append(w), plain(w))[1])
    monkeypatch.setattr(lm_scoring, "HELD", 3)
    for wanted in (False, True):
        hashed.clear()
        table = lm_scoring.Subwords(path, vocab.PATTERN, np.ones(size, np.int16), np.zeros(size, np.float32))
        for docs in ([b"one two one".split(), []], [b"three two".split()], [b"four five one".split()], [b"six one one".split()], []):
            numbers = table.numbers(docs, **({"hashed": True} if wanted else {}))
            words = [w for d in docs for w in d]
            ids, _, sizes, _ = table.spread(numbers, np.array([len(d) for d in docs], dtype=np.int64))
            assert ids[ids >= 0].tolist() == table.encoder.encode(words)[0].tolist()
            assert not wanted or table.hashes[numbers].tolist() == [plain(w) for w in words]
        assert bool(hashed) == wanted


def test_lm_gradient():
    rng = np.random.default_rng(2)
    model = lm_scoring.Attention(7, np.array([1, 1, 0, 1, 0, 1, 0], dtype=bool))
    model.p = {k: rng.normal(size=x.shape) + (x if k == "inner_before" else 0) for k, x in model.p.items()}
    classes = rng.integers(0, 7, 50)
    source, there, target = lm_scoring.windows(np.array([50]))
    ids, goal, scored = np.r_[classes, 0][source], np.r_[classes, 0][target], (target >= 0).astype(float)
    _, g = model.gradients(ids, there, goal, scored)
    for name in model.p:
        at = tuple(rng.integers(0, s) for s in model.p[name].shape)
        if name.startswith("inner"):  # a class that is there
            at = (0, *at[1:-1], 0) if name == "inner_u" else (at[0], 0, 1)
        old, step = model.p[name][at], 1e-5
        model.p[name][at] = old + step
        up, _ = model.gradients(ids, there, goal, scored)
        model.p[name][at] = old - step
        down, _ = model.gradients(ids, there, goal, scored)
        model.p[name][at] = old
        assert g[name][at] == pytest.approx((up - down) / (2 * step), abs=1e-4)


def test_lm_learns(llm, vocab):
    rows = [(i, text_in(("en", "de", "fr")[i % 3], i, 60)) for i in range(120)]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string")
    scored = lm_scoring.score_texts(docs, F.col("doc_id") % 5 != 1, vocab.path("byte_bpe_50k.tiktoken"), vocab.PATTERN, steps=150, sample=100).collect()
    held = [r for r in scored if r.doc_id % 5 == 1]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_pairs_of_whole_texts(llm, vocab):
    """What follows what is learned from the ends of long texts and from texts the network is not fit on."""
    path, words = vocab.path("byte_bpe_50k.tiktoken"), "river stone candle".split()
    filler = text_in("en", 1, 1600)
    for texts in (lambda end: [filler + " " + end], lambda end: [text_in("en", i, 30) for i in range(8)] + [end]):
        rng, scores = random.Random(3), []
        mixed = words * 100
        rng.shuffle(mixed)
        for end in (words * 100, mixed):  # the same counts
            rows = list(enumerate([*texts(" ".join(end)), " ".join(words * 4)]))
            docs = llm.createDataFrame(rows, "doc_id bigint, text string")
            scored = lm_scoring.score_texts(docs, F.col("doc_id") != len(rows) - 1, path, vocab.PATTERN, steps=0, sample=1).collect()
            scores.append(next(r.score for r in scored if r.doc_id == len(rows) - 1))
        assert scores[0] > scores[1] + 1


def test_lm_network_reads_every_training_window(llm, vocab, monkeypatch):
    """The first fit is on one document; what follows comes from a pass over all windows of all training texts, each once,
    however the rows are dealt, and the shards' weights are averaged by their windows."""
    path, rng = vocab.path("byte_bpe_50k.tiktoken"), np.random.default_rng(8)
    size = max(lm_scoring.load_ranks(path).values()) + 1
    class_of = np.where(np.arange(size) % 3 == 0, 3 + np.arange(size) % 5, 1 + np.arange(size) % 2).astype(np.int16)
    table, starts = (path, vocab.PATTERN, class_of, np.zeros(size, np.float32)), np.array([1, 1, 0, 1, 0, 1, 0, 1], dtype=bool)
    rows = [(i % 9, text_in(("en", "de", "fr")[i % 3], i, int(rng.integers(0, 300)))) for i in range(40)] + [(3, ""), (3, "")]
    subwords = lm_scoring.Subwords(*table)
    words = [lm_scoring.words_of(t.encode()) for _, t in rows]
    _, _, _, lengths = subwords.spread(subwords.numbers(words), np.array([len(w) for w in words]))
    monkeypatch.setattr(lm_scoring, "SHARD_IDS", int(lengths.sum()) // 3)
    monkeypatch.setattr(lm_scoring, "PART", 100)
    network, seen = lm_scoring.Attention(8, starts).p, []
    for parts in (1, 4):
        learn = llm.createDataFrame(rows, "key bigint, text string").repartition(parts)
        read = lm_scoring.read_classes(learn, table, 8)
        assert sorted(r.n for r in read.filter("kind = 2").collect()) == sorted(lengths.tolist())
        found = lm_scoring.fit_shards(read, int(lengths.sum()), starts, network)
        assert all(found[n].shape == x.shape and np.isfinite(found[n]).all() for n, x in network.items())
        seen.append(found)
    assert all(np.allclose(seen[0][n], seen[1][n], atol=1e-6) for n in network)
    assert not np.allclose(seen[0]["q"], network["q"])
    shards = max(1, math.ceil(int(lengths.sum()) / lm_scoring.SHARD_IDS))
    total, windows = {n: 0.0 for n in network}, 0
    for shard in range(shards):
        own = sorted((r.key, bytes(r.classes)) for r in read.filter("kind = 2").collect() if r.key % shards == shard)
        model = lm_scoring.Attention(8, starts)
        visited, gradients = [], model.gradients
        model.gradients = lambda ids, there, goal, scored: (visited.append(int(scored.sum())), gradients(ids, there, goal, scored))[1]  # noqa: B023
        n = lm_scoring.go_on(model, np.frombuffer(b"".join(t for _, t in own), np.int16), np.array([len(t) // 2 for _, t in own]), shard)
        assert sum(visited) == sum(len(t) // 2 for _, t in own)  # every id is a target once
        windows += n
        total = {name: total[name] + n * x.astype(np.float64) for name, x in model.p.items()}
    assert windows == int((-(-lengths // lm_scoring.STRIDE)).sum())
    assert all(np.allclose(total[n] / windows, seen[0][n], atol=1e-5) for n in network)


def test_lm_score_reads_texts_outside_the_sample(llm, vocab, monkeypatch):
    passes, go_on = [], lm_scoring.fit_shards
    monkeypatch.setattr(lm_scoring, "fit_shards", lambda read, *rest: (passes.append(read.filter("kind = 2").count()), go_on(read, *rest))[1])
    docs = llm.createDataFrame([(i, text_in("en", i, 50)) for i in range(30)], "doc_id bigint, text string")
    scored = lm_scoring.score_texts(docs, F.col("doc_id") % 5 != 1, vocab.path("byte_bpe_50k.tiktoken"), vocab.PATTERN, steps=2, sample=1)
    assert scored.count() == 30 and passes == [24]


def test_lm_pairs_by_brute_force(llm, vocab, monkeypatch):
    path, texts = vocab.path("byte_bpe_50k.tiktoken"), [text_in(("en", "de", "fr")[i % 3], i, 400) for i in range(9)] + [""]
    size = max(lm_scoring.load_ranks(path).values()) + 1
    class_of = np.where(np.arange(size) % 3 == 0, 3 + np.arange(size) % 5, 1 + np.arange(size) % 2).astype(np.int16)
    table = (path, vocab.PATTERN, class_of, np.zeros(size, np.float32))
    subwords, want, tail = lm_scoring.Subwords(*table), np.zeros((8, 8)), Counter()
    for t in texts:
        words = lm_scoring.words_of(t.encode())
        ids, classes, _, _ = subwords.spread(subwords.numbers([words]), np.array([len(words)]))
        for before, c, i in zip([0, *classes[:-1]], classes, ids, strict=True):
            want[before, c] += 1
            if c in (1, 2):
                tail[before * size + i] += 1
    docs = llm.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    classes, pairs = lm_scoring.count_pairs(docs, table, 8)
    assert (classes == want).all() and (pairs.totals == want[:, :3]).all()
    assert dict(zip(pairs.keys.tolist(), pairs.counts.tolist(), strict=True)) == tail and (np.diff(pairs.keys) > 0).all()


def test_lm_empty(no_docs, vocab):
    out = lm_scoring.score_texts(no_docs, F.lit(True), vocab.path("byte_bpe_50k.tiktoken"), vocab.PATTERN, steps=2)
    assert out.count() == 0


def test_used_numbers_are_found_without_a_sort(monkeypatch):
    numbers = np.random.default_rng(6).zipf(1.3, 5000) % 700
    want = np.unique(numbers, return_inverse=True)
    monkeypatch.setattr(np, "unique", None)
    for a, b in zip(lm_scoring._used(numbers, 700), want, strict=True):
        assert a.tolist() == b.tolist()
    assert [x.tolist() for x in lm_scoring._used(numbers[:0], 0)] == [[], []]
