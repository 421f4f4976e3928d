"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence has a logistic score over hashed features of its words, a
document is toxic if any of its sentences is: the sentence scores are combined by noisy-or, and the
weights are fit on the documents' labels alone. The sentence scores then locate the offending sentences.

Features of a word (a run without white space, outer punctuation off, lower-case): the word and its
first four to six bytes. Weights live in one hashed table of fixed size that travels to the executors.
The fit uses a bounded sample of labelled documents (``SAMPLE``); scoring reads every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaprep.llm.common import slices

SLOTS = 1 << 18
#: Labelled documents the fit reads: the smallest by a hash of the id, at most this many of each label.
SAMPLE = 2000
#: Words of a sampled clean document whose sentences travel to the fit; a longer one is spread out. Toxic ones go whole.
SAMPLE_WORDS = 3000
ROUNDS = 80
SPARSE = 0.3

_SENTENCE = re.compile(rb"[^.!?\n]*[.!?\n]*")
_EDGES = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _slots(word: bytes) -> tuple[int, ...]:
    """Hashed slots of the features of a word."""
    import xxhash

    word = word.strip(_EDGES)
    if not word:
        return ()
    parts = [b"w" + word] + [b"p" + word[:n] for n in (4, 5, 6) if len(word) >= n]
    return tuple({xxhash.xxh64_intdigest(p) & (SLOTS - 1) for p in parts})


def _sentences(text: bytes) -> list[tuple[int, int]]:
    """Start and end of the sentences that hold a word; the end marks belong to their sentence."""
    return [m.span() for m in _SENTENCE.finditer(text) if m.group().strip()]


@dataclass
class Model:
    """Weights by slot and the bias of a sentence."""

    weights: np.ndarray
    bias: float


def _noisy_or(log_clean: np.ndarray, bags: np.ndarray, count: int) -> np.ndarray:
    """1 - product of (1 - p) over the sentences of each bag."""
    return -np.expm1(np.bincount(bags, weights=log_clean, minlength=count))


def fit(slots: np.ndarray, sentence_of: np.ndarray, doc_of: np.ndarray, labels: np.ndarray, importance: np.ndarray | None = None, rounds: int = ROUNDS) -> Model:
    """Full-batch Adam on the weighted log loss of the noisy-or. Weights are zero or positive and pay
    ``SPARSE`` (in units of one toxic document's share of the loss), so that only words that many toxic
    and hardly any clean documents hold get one; the words of a long sentence add no noise.

    ``slots`` and ``sentence_of``: an entry per feature; ``doc_of``: the document of each sentence;
    ``labels``: 0 or 1 per document. Without both labels every score is what the bias can say."""
    count, sentences = len(labels), len(doc_of)
    importance = np.ones(count) if importance is None else importance
    weights, rate = np.zeros(SLOTS, dtype=np.float32), float(np.clip(np.average(labels, weights=importance) if count else 0.0, 1e-4, 1 - 1e-4))
    per_doc = max(1.0, sentences / max(1, count))
    bias = float(np.log(np.expm1(-np.log1p(-rate) / per_doc)))
    if count == 0 or labels.min() == labels.max():
        return Model(weights, bias)
    used, slot = np.unique(slots, return_inverse=True)
    slot = slot.astype(np.int32)
    w, m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    importance = importance / importance.sum()
    price = SPARSE * importance[labels == 1].mean()
    for step in range(1, rounds + 1):
        z = np.clip(np.bincount(sentence_of, weights=w[slot], minlength=sentences) + bias, -30, 30)
        p = 1 / (1 + np.exp(-z))
        doc = np.clip(_noisy_or(-np.logaddexp(0, z), doc_of, count), 1e-9, 1 - 1e-9)
        # d loss / d z of a sentence: p for a clean document, -p (1 - P) / P for a toxic one
        g_z = p * (np.where(labels == 1, -(1 - doc) / doc, 1.0) * importance)[doc_of]
        g = np.bincount(slot, weights=g_z[sentence_of], minlength=len(used)) + price
        gb = g_z.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        a, b = 1 - 0.9**step, 1 - 0.99**step
        w = np.maximum(0.0, w - 0.25 * (m / a) / (np.sqrt(v / b) + 1e-9))
        bias -= 0.1 * float((mb / a) / (np.sqrt(vb / b) + 1e-9))
    weights[used] = w
    return Model(weights, bias)


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The slots of each sentence of the sampled documents, as one array with -1 between sentences."""
    for batch in slices(batches, "text"):
        out = []
        for text, label in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("label").to_pylist(), strict=True):
            text = (text or b"").lower()
            flat: list[int] = []
            spans = _sentences(text)
            # any sentence of a toxic document may be the one that makes it so
            step = 1 if label else max(1, -(-len(text.split()) // SAMPLE_WORDS))
            for start, end in spans[::step]:
                for word in dict.fromkeys(text[start:end].split()):
                    flat.extend(_slots(word))
                flat.append(-1)
            out.append(np.asarray(flat, dtype=np.int32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(out, pa.binary())], names=["doc_id", "label", "slots"])


def _fitter(totals: dict[int, int], rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, parts = [], []
        for batch in batches:
            labels += batch.column("label").to_pylist()
            parts += [np.frombuffer(raw, dtype=np.int32) for raw in batch.column("slots").to_pylist()]
        y = np.asarray(labels, dtype=np.int64)
        flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        ends = flat < 0
        sentence = (np.cumsum(ends) - ends).astype(np.int32)
        doc_of = np.repeat(np.arange(len(parts)), [int((p < 0).sum()) for p in parts])
        share = np.array([max(1, (y == c).sum()) for c in (0, 1)], dtype=float)
        whole = np.array([totals.get(c, 0) for c in (0, 1)], dtype=float)
        model = fit(flat[~ends], sentence[~ends], doc_of, y, (whole / share)[y] if len(y) else None, rounds)
        yield pa.RecordBatch.from_pydict({"weights": [model.weights.tobytes()], "bias": [model.bias]})

    return run


def train(docs: DataFrame, labels: DataFrame, usable: Column, sample: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    """Fit on documents whose label is 0 or 1 and for which ``usable`` (of ``doc_id``) holds.

    Of each label the ``sample`` documents with the smallest hash of their id are read, and fit in one
    task; the weights of the loss restore the shares the labels have in the whole table."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).filter(usable).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("label"))
    totals = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    zero, one = (known.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for c in (0, 1))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(zero.union(one)), "doc_id")  # at most 2 * sample ids
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))  # a repeated row is read once
    features = rows.select("doc_id", "label", "text").mapInArrow(_sample_features, "doc_id bigint, label int, slots binary")
    one_task = features.repartition(1).sortWithinPartitions("doc_id", "slots")
    row = one_task.mapInArrow(_fitter(totals, rounds), "weights binary, bias double").first()
    if row is None:  # no labelled document: nothing looks toxic
        nothing = np.zeros(0, dtype=np.int64)
        return fit(nothing, nothing, nothing, nothing)
    return Model(np.frombuffer(row.weights, dtype=np.float32), row.bias)


def _scorer(model: Model, locate: bool):
    weights, bias = model.weights, model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, float] = {}
        for batch in slices(batches, "text"):
            scores, spans_out = [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                text = text or b""
                low = text.lower()
                spans, sums = _sentences(low), []
                for start, end in spans:
                    total = 0.0
                    for word in dict.fromkeys(low[start:end].split()):
                        value = known.get(word)
                        if value is None:
                            if len(known) > 500_000:
                                known.clear()
                            value = known[word] = float(sum(weights[s] for s in _slots(word)))
                        total += value
                    sums.append(total)
                z = np.clip(np.asarray(sums) + bias, -30, 30)
                scores.append(float(-np.expm1(-np.logaddexp(0, z).sum())) if spans else 0.0)
                if locate:
                    spans_out.append([{"start": a, "end": b, "score": float(1 / (1 + np.exp(-x)))} for (a, b), x in zip(spans, z, strict=True) if x >= 0])
            columns, names = [batch.column(i) for i in range(batch.num_columns)] + [pa.array(scores, pa.float64())], [*batch.schema.names, "_score"]
            if locate:
                columns.append(pa.array(spans_out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))))
                names.append("_sentences")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, sentences`` of every row: the noisy-or of its sentences, and the sentences whose
    own score is 0.5 or more (start and end in UTF-8 bytes). A text without a sentence (null, empty, white space)
    scores 0. Repeated rows and null ids are scored like any other; an empty table gives no rows."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(_scorer(model, True), "doc_id bigint, text string, _score double, _sentences array<struct<start: bigint, end: bigint, score: double>>")
    return out.select("doc_id", F.col("_score").alias("score"), F.col("_sentences").alias("sentences"))


def drop_toxic(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below ``limit``. No row is shuffled."""
    fields = ", ".join(f"`c{i}` {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)], F.col("text").cast("string").alias("text"))
    out = plain.mapInArrow(_scorer(model, False), f"{fields}, text string, _score double").filter(F.col("_score") < limit)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
