"""Language of texts by a linear-chain conditional random field over words.

A chain is a line, or a part of a longer one (``CHAIN`` words at most). A run of more than ``PIECE`` characters without
a blank counts as several words, pieces that overlap so that none of its n-grams is lost. A word's features are the word itself and
its neighbours' (the lexicon), its affixes and its byte n-grams, hashed into a table of fixed size; the
chain has learned weights between the labels of neighbouring words and for its first word. Forward and
backward sums give each word's label probabilities, so a text that changes its language is labelled
word by word; a document's language is the one with the largest sum over its words.

Documents carry one label, so the words of a training document all count as that label; the few that
differ (code-switched text, names) are outvoted in the lexicon. The fit reads a bounded sample
(``SAMPLE`` documents of each label, ``SAMPLE_CHAINS`` chains of each); the labels and their shares come from all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaprep.llm.common import slices

SLOTS = 1 << 17
CHAIN = 64
#: Documents of a label that the fit reads, the smallest by a hash of the id; chains read from one of them.
SAMPLE = 400
SAMPLE_CHAINS = 6
SALTS = 32
ROUNDS = 30
#: Characters of a word at most, and those that neighbouring pieces of a longer run share.
PIECE, OVERLAP = 16, 2
_AFFIXES = 8
_PLACES = _AFFIXES + PIECE
_EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789"


def _word_slots(word: str) -> list[int]:
    """Slots of a word's features, ``_PLACES`` of them; none for a run without letters."""
    import xxhash

    word = word.strip(_EDGES).lower()
    if not (word.isalpha() or any(c.isalpha() for c in word)):
        return []
    w = word.encode()
    if len(w) == len(word):  # a byte per character
        closed = b"<" + w + b">"
        parts = [b"w" + w, b"a" + w[:2], b"a" + w[:3], b"a" + w[:4], b"z" + w[-1:], b"z" + w[-2:], b"z" + w[-3:], b"z" + w[-4:]]
        parts += [b"g" + closed[i : i + 3] for i in range(len(closed) - 2)]
    else:
        closed = f"<{word}>"
        affixes = ["w" + word, "a" + word[:2], "a" + word[:3], "a" + word[:4], "z" + word[-1:], "z" + word[-2:], "z" + word[-3:], "z" + word[-4:]]
        parts = [p.encode() for p in affixes + ["g" + closed[i : i + 3] for i in range(len(closed) - 2)]]
    return [x & (SLOTS - 1) for x in map(xxhash.xxh32_intdigest, parts)]


def _word_scores(words: list[str], emission: np.ndarray) -> np.ndarray:
    """The sum of the weights of each word's features, a row per word; zero without features."""
    out = np.zeros((len(words), emission.shape[1]), dtype=np.float32)
    step = max(256, (1 << 21) // (_PLACES * max(1, emission.shape[1])))
    for at in range(0, len(words), step):
        slots = [_word_slots(w) for w in words[at : at + step]]
        n = np.array([len(s) for s in slots])
        some = np.flatnonzero(n)
        if len(some):
            flat = np.array([x for own in slots for x in own])
            out[at + some] = np.add.reduceat(emission[flat], (np.cumsum(n) - n)[some], axis=0)
    return out


def _pieces(run: str) -> list[str]:
    """The run, or pieces of a longer one; lower-casing may lengthen a text, so it comes first."""
    run = run.strip(_EDGES).lower()
    if len(run) <= PIECE:
        return [run]
    return [run[i : i + PIECE] for i in range(0, len(run) - OVERLAP, PIECE - OVERLAP)]


def chains_of(text: str, size: int = CHAIN) -> list[list[str]]:
    """The words that have a letter, line by line, cut at ``size``."""
    out = []
    for line in text.split("\n"):
        words = [w for run in line.split() for w in _pieces(run) if any(c.isalpha() for c in w)] if line else []
        out += [words[i : i + size] for i in range(0, len(words), size)]
    return out


class RunNumbers(dict):
    """Runs without a blank to the numbers of their words (those of ``chains_of``), four bytes each; a run is
    cut into words and looked at once. ``fresh``: the words numbered since it was last emptied, in order."""

    def __init__(self) -> None:
        super().__init__()
        self.number: dict[str, int] = {}
        self.fresh: list[str] = []

    def __missing__(self, run: str) -> bytes:
        own = []
        for word in _pieces(run):
            if word.isalpha() or any(c.isalpha() for c in word):
                at = self.number.get(word)
                if at is None:
                    at = self.number[word] = len(self.number)
                    self.fresh.append(word)
                own.append(at)
        found = self[run] = np.array(own, dtype=np.int32).tobytes()
        return found

    def of(self, text: str) -> list[bytes]:
        """The numbers of each line's words."""
        return [b"".join(map(self.__getitem__, line.split())) for line in text.split("\n")]


@dataclass
class Model:
    labels: list[str]
    emission: np.ndarray  # slots x labels; the last row is for words that are not there
    transition: np.ndarray  # labels x labels
    start: np.ndarray


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transition: np.ndarray, start: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Label probabilities (chains x words x labels) of padded chains, all chains in step; with ``pairs`` also
    the expected transitions. Sums are scaled at every word, so no length under- or overflows."""
    chains, longest, count = scores.shape
    top = scores.max(axis=2, keepdims=True)
    local = np.exp(scores - top)
    move = np.exp(transition).astype(scores.dtype)
    forward = np.empty_like(local)
    backward = np.ones_like(local)
    if longest == 0 or chains == 0:
        return local, np.zeros((count, count)) if pairs else None
    now = local[:, 0] * np.exp(start - start.max()).astype(scores.dtype)
    forward[:, 0] = now / now.sum(axis=1, keepdims=True)
    for t in range(1, longest):
        now = (forward[:, t - 1] @ move) * local[:, t]
        forward[:, t] = now / now.sum(axis=1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        now = (backward[:, t + 1] * local[:, t + 1]) @ move.T
        now /= now.sum(axis=1, keepdims=True)
        backward[:, t] = np.where((t + 1 < lengths)[:, None], now, 1.0)
    marginal = forward * backward
    marginal /= marginal.sum(axis=2, keepdims=True)
    marginal *= (np.arange(longest) < lengths[:, None])[:, :, None]
    if not pairs:
        return marginal, None
    expected = np.zeros((count, count))
    for t in range(1, longest):
        live = t < lengths
        before, after = forward[live, t - 1], local[live, t] * backward[live, t]
        total = ((before @ move) * after).sum(axis=1, keepdims=True)
        expected += move * ((before / total).T @ after)
    return marginal, expected


def fit(slots: np.ndarray, lengths: np.ndarray, label: np.ndarray, labels: list[str], rounds: int = ROUNDS) -> Model:
    """Gradient ascent (Adam) on the chains' log likelihood with a small pull to zero.

    ``slots``: words x places, of all chains in a row (empty places hold ``SLOTS``); ``label``: of each chain."""
    count = len(labels)
    model = Model(labels, np.zeros((SLOTS + 1, count), dtype=np.float32), np.zeros((count, count)), np.zeros(count))
    if count < 2 or len(lengths) == 0:
        return model
    rng = np.random.default_rng(7)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    first, second = np.zeros_like(model.emission), np.zeros_like(model.emission)
    t1, t2, s1, s2 = np.zeros((count, count)), np.zeros((count, count)), np.zeros(count), np.zeros(count)
    step, size = 0, max(32, min(512, 32768 // count))
    for _ in range(max(1, min(rounds, 1 + rounds * 4096 // max(1, len(lengths))))):
        order = rng.permutation(len(lengths))
        for at in range(0, len(order), size):
            step += 1
            some = order[at : at + size]
            n = lengths[some]
            inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            row = np.repeat(np.arange(len(some)), n)
            words = slots[np.repeat(begins[some], n) + inner].astype(np.int64)
            scores = np.zeros((len(some), int(n.max()), count))
            scores[row, inner] = model.emission[words].sum(axis=1)
            marginal, expected = forward_backward(scores, n, model.transition, model.start, pairs=True)
            truth = label[some]
            error = marginal[row, inner]
            error[np.arange(len(row)), truth[row]] -= 1.0
            error /= len(row)
            used, place = np.unique(words, return_inverse=True)
            gradient = np.empty((len(used), count), dtype=np.float32)
            for c in range(count):
                gradient[:, c] = np.bincount(place.ravel(), weights=np.repeat(error[:, c], slots.shape[1]), minlength=len(used))
            gradient += 1e-6 * model.emission[used]
            first[used] = 0.9 * first[used] + 0.1 * gradient
            second[used] = 0.99 * second[used] + 0.01 * gradient**2
            model.emission[used] -= 0.05 * first[used] / (np.sqrt(second[used]) + 1e-6)
            for truth_label in range(count):
                expected[truth_label, truth_label] -= float((n[truth == truth_label] - 1).sum())
            g_t, g_s = expected / len(row) + 1e-4 * model.transition, (marginal[:, 0].sum(axis=0) - np.bincount(truth, minlength=count)) / len(row)
            t1, t2, s1, s2 = 0.9 * t1 + 0.1 * g_t, 0.99 * t2 + 0.01 * g_t**2, 0.9 * s1 + 0.1 * g_s, 0.99 * s2 + 0.01 * g_s**2
            model.transition -= 0.02 * t1 / (np.sqrt(t2) + 1e-6)
            model.start -= 0.02 * s1 / (np.sqrt(s2) + 1e-6)
            model.emission[SLOTS] = 0
    # a single label per training document makes any change of label look impossible; keep it possible
    model.transition = np.clip(model.transition, -2.0, 2.0)
    return model


def _sample_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        chains, counts = [], []
        for text in batch.column("text").to_pylist():
            own = chains_of(text or "")
            picked = own[:: max(1, -(-len(own) // SAMPLE_CHAINS))]
            rows = [(_word_slots(w) + [SLOTS] * _PLACES)[:_PLACES] for c in picked for w in c]
            chains.append(np.asarray(rows, dtype=np.int32).tobytes())
            counts.append([len(c) for c in picked])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(chains, pa.binary()), pa.array(counts, pa.list_(pa.int32()))], names=["doc_id", "lang", "slots", "counts"])


def _fitter(labels: list[str], rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, lengths, label = [], [], []
        number = {name: i for i, name in enumerate(labels)}
        for batch in batches:
            for lang, raw, counts in zip(batch.column("lang").to_pylist(), batch.column("slots").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                parts.append(np.frombuffer(raw, dtype=np.int32))
                lengths += counts
                label += [number[lang]] * len(counts)
        flat = np.concatenate(parts).reshape(-1, _PLACES) if parts else np.zeros((0, _PLACES), np.int32)
        model = fit(flat, np.asarray(lengths, dtype=np.int64), np.asarray(label, dtype=np.int64), labels, rounds)
        yield pa.RecordBatch.from_pydict({"emission": [model.emission.tobytes()], "transition": [model.transition.tobytes()], "start": [model.start.tobytes()]})

    return run


def train(docs: DataFrame, usable: Column, sample: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    """Fit on rows with a language for which ``usable`` (of ``doc_id``) holds, in one task over the sample."""
    known = docs.filter(F.col("lang").isNotNull()).filter(usable).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang")).distinct()
    labels = sorted(r.lang for r in known.select("lang").distinct().collect())  # a row per language
    if not labels:
        return Model([], np.zeros((SLOTS + 1, 0), np.float32), np.zeros((0, 0)), np.zeros(0))
    # the smallest hashes of each label: within parts of it first, so that no label's rows meet in one task
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    salted = known.withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(SALTS)))
    cut = salted.withColumn("nth", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("nth") <= sample)
    picked = cut.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("nth") <= sample).select("doc_id", "lang")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = texts.join(F.broadcast(picked), ["doc_id", "lang"])  # at most ``sample`` ids of a label
    rows = rows.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))  # a repeated row is read once
    features = rows.select("doc_id", "lang", "text").mapInArrow(_sample_words, "doc_id bigint, lang string, slots binary, counts array<int>")
    row = features.repartition(1).sortWithinPartitions("doc_id", "lang", "slots").mapInArrow(_fitter(labels, rounds), "emission binary, transition binary, start binary").first()
    count = len(labels)
    return Model(labels, np.frombuffer(row.emission, dtype=np.float32).reshape(-1, count), np.frombuffer(row.transition).reshape(count, count), np.frombuffer(row.start))


def _predict(model: Model, spans: bool):
    labels, emission, transition, start = model.labels, model.emission, model.transition, model.start
    count = len(labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = RunNumbers()
        scores = np.zeros((1 << 12, count), dtype=np.float32)
        for batch in slices(batches, "text", 2 << 20):
            if len(table) > min(300_000, 20_000_000 // max(1, count)):
                table, scores = RunNumbers(), np.zeros((1 << 12, count), dtype=np.float32)
            lines = [table.of(t or "") for t in batch.column("text").to_pylist()]
            while len(scores) < len(table.number):
                scores = np.concatenate([scores, np.zeros_like(scores)])
            scores[len(table.number) - len(table.fresh) : len(table.number)] = _word_scores(table.fresh, emission)
            table.fresh = []
            words = np.frombuffer(b"".join(line for own in lines for line in own), dtype=np.int32)
            # chains: the lines, longer ones in parts
            in_line = np.array([len(line) // 4 for own in lines for line in own], dtype=np.int64)
            parts = -(-in_line // CHAIN)
            doc = np.repeat(np.repeat(np.arange(len(lines)), [len(own) for own in lines]), parts)
            lengths = np.full(len(doc), CHAIN, dtype=np.int64)
            last = np.cumsum(parts)[parts > 0] - 1
            lengths[last] = in_line[parts > 0] - (parts[parts > 0] - 1) * CHAIN
            begins = np.cumsum(lengths) - lengths
            sums = np.zeros((len(lines), count))
            best: list[np.ndarray] = [np.zeros(0, np.int64)] * len(doc)
            order = np.argsort(lengths, kind="stable")
            size = max(16, min(1024, 65536 // max(1, count)))
            for at in range(0, len(order), size) if count else ():
                some = order[at : at + size]
                n = lengths[some]
                row = np.repeat(np.arange(len(some)), n)
                inner = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                padded = np.zeros((len(some), int(n.max()), count), dtype=np.float32)
                padded[row, inner] = scores[words[begins[some][row] + inner]]
                marginal, _ = forward_backward(padded, n, transition, start)
                np.add.at(sums, doc[some], marginal.sum(axis=1))
                if spans:
                    for i, m, length in zip(some, marginal.argmax(axis=2), n, strict=True):
                        best[i] = m[:length]
            total = sums.sum(axis=1)
            known = total > 0
            top = sums.argmax(axis=1) if count else np.zeros(len(lines), np.int64)
            names = [labels[t] if k else "und" for t, k in zip(top, known, strict=True)]
            score = np.where(known, sums.max(axis=1, initial=0.0) / np.where(known, total, 1.0), 0.0)
            columns, fields = [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(np.minimum(score, 1.0), pa.float64())], ["doc_id", "lang_pred", "score"]
            if spans:
                changes: list[list[dict]] = [[] for _ in lines]
                for own, labelled in zip(doc, best, strict=True):
                    for b in labelled:
                        if changes[own] and changes[own][-1]["lang"] == labels[b]:
                            changes[own][-1]["words"] += 1
                        else:
                            changes[own].append({"lang": labels[b], "words": 1})
                columns.append(pa.array(changes, pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))))
                fields.append("runs")
            yield pa.RecordBatch.from_arrays(columns, names=fields)

    return run


def predict(docs: DataFrame, model: Model, runs: bool = True) -> DataFrame:
    """``doc_id, lang_pred, score`` (the language's share of the words' probabilities) and, with ``runs``,
    the runs of words of one language in their order.

    ``und`` with score 0 if the text is null, has no letter, or nothing was learned. Repeated rows and null ids are
    rows like any other; an empty table gives no rows."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id bigint, lang_pred string, score double" + (", runs array<struct<lang: string, words: bigint>>" if runs else "")
    return rows.mapInArrow(_predict(model, runs), schema)
