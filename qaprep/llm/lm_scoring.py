"""Language-model scores of whole texts by a causal self-attention model over subword ids.

Tokens of a text are its words (runs without white space, A-Z lower-cased) and one end. A word's subword ids are
the BPE ids of a blank and the word, so a word ends where the next id starts one. The model predicts
each id from the ids before it in a window: one head of causal attention with learned weights by distance,
and the id just before. Frequent ids are predicted one by one, the others as two classes (those that
start a word, those that go on) times their share of the class: in the whole training part of the corpus,
corrected by how often they follow the class before there.
Windows overlap: the first ``WINDOW - STRIDE`` places of a window are context only, so every id is scored
once, with at least that much context. Windows of all texts of a slice run as masked batches.

From the ids' probabilities follows a word's, given the text before it: its ids, and that it ends there. The
score mixes it with the word's share of the training corpus (words never seen there have the model's part only):
log10(MIX * model + (1 - MIX) * share), summed over the tokens.

Word counts, subword counts, totals and pairs (of classes, and of a class and the id behind it) cover the whole
training part. The most frequent words (a bounded table) travel to the tasks; the rest meet their counts by a join on the
word's 64-bit hash. All pairs travel: at most one for each class and id, whatever the size of the corpus. The table of the id
before starts from the pairs; the network's weights start from a fit in one task on windows from anywhere in ``SAMPLE`` training documents.
From there shards of the whole training part go on side by side, each in one pass over all its windows, and the weights
they end with are averaged by their numbers of windows (parameter mixing, McDonald et al. 2010).
"""

from __future__ import annotations

import math
import pickle
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaprep.llm.bpe import load_ranks
from qaprep.llm.common import id_of, keyed, sampled, slices
from qaprep.session import write_through

#: Ids predicted one by one, beside the end and the two classes of the others.
CLASSES = 509
#: Classes of a group at most.
GROUP = 32
WIDTH = 16
WINDOW, STRIDE = 32, 24
MIX = 0.7
#: Words whose counts travel to the tasks, at most.
FREQUENT = 1 << 18
#: Training documents of the network's first fit, whole (the smallest by a hash of id and text).
SAMPLE = 1500
STEPS, BATCH = 1000, 64
#: Ids of a shard of the training part, about; windows of a step of its pass, and the rate at first.
SHARD_IDS, SHARD_BATCH, SHARD_RATE = 1 << 21, 512, 0.002
#: Weights averaged at once.
PART = 1 << 14
#: Words counted before a task sends its counts on, and pairs.
HELD, HELD_PAIRS = 400_000, 4_000_000

#: Pairs that a class before must have been seen in until its own shares count as much as the whole corpus's.
TRUST = 20.0

END = 0  # also stands ahead of the first id
_OTHER_START, _OTHER_ON = 1, 2
_LN10 = math.log(10.0)


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()  # of bytes: A-Z, and the six white-space bytes


def _hash(word: bytes) -> int:
    import xxhash

    value = xxhash.xxh3_64_intdigest(word)
    return value - (1 << 64) if value >> 63 else value


class WordIds:
    """BPE ids of a blank and a word, from the ``tiktoken`` library, many words in one text: a new word starts
    where an id starts with a blank, as words hold none."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        ranks = load_ranks(path)
        self.encoding = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.blank = np.zeros(max(ranks.values()) + 1, dtype=bool)
        self.blank[[rank for token, rank in ranks.items() if token[:1] == b" "]] = True

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and how many each word has."""
        flat, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), 4096):
            some = words[at : at + 4096]
            ids = np.asarray(self.encoding.encode_ordinary((b" " + b" ".join(some)).decode()), dtype=np.int64)
            starts = np.flatnonzero(self.blank[ids])
            if len(starts) != len(some):  # white space of other kinds at a word's edge joined two of them
                each = [self.encoding.encode_ordinary((b" " + w).decode()) for w in some]
                flat.append(np.array([x for e in each for x in e], dtype=np.int64))
                sizes.append(np.array([len(e) for e in each]))
            else:
                flat.append(ids)
                sizes.append(np.diff(np.r_[starts, len(ids)]))
        return np.concatenate(flat), np.concatenate(sizes)


def _count(path: str, pattern: str):
    """Rows (kind, h, n): words by hash (0), subword ids (1), documents (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, held, documents = None, Counter(), 0

        def sent() -> pa.RecordBatch:
            names = list(held)
            n = np.fromiter(held.values(), dtype=np.int64, count=len(names))
            ids, sizes = encoder.encode(names)
            subword = np.bincount(ids, weights=np.repeat(n, sizes)).astype(np.int64)
            there = np.flatnonzero(subword)
            kind = np.r_[np.zeros(len(names)), np.ones(len(there)), 2].astype(np.int32)
            h = np.r_[np.array([_hash(w) for w in names], dtype=np.int64), there, 0]
            return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(h, pa.int64()), pa.array(np.r_[n, subword[there], documents], pa.int64())], names=["kind", "h", "n"])

        for batch in slices(batches, "text"):
            encoder = encoder or WordIds(path, pattern)
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                held.update(words_of(text))
                documents += 1
            if len(held) > HELD:
                yield sent()
                held, documents = Counter(), 0
        if documents:
            yield sent()

    return run


def _before(classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The class ahead of each id; the end ahead of a text's first."""
    out = np.r_[END, classes[:-1]].astype(np.int64)
    out[np.cumsum(lengths)[:-1]] = END
    return out[: len(classes)]


@dataclass
class Pairs:
    """How often an id without a class of its own follows a class, in the whole training part."""

    keys: np.ndarray
    counts: np.ndarray
    totals: np.ndarray


class Subwords:
    """Class and within-class log probability of the ids of words."""

    def __init__(self, path: str, pattern: str, class_of: np.ndarray, log_share: np.ndarray):
        self.encoder = WordIds(path, pattern)
        self.class_of, self.log_share = class_of, log_share
        self._clear()

    def _clear(self) -> None:
        self.number: defaultdict[bytes, int] = defaultdict(count().__next__)  # a new word takes the next number
        self.ids = np.zeros(1 << 16, np.int32)
        self.starts, self.hashes = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)
        self.filled = 0

    def numbers(self, docs: list[list[bytes]], hashed: bool = False) -> np.ndarray:
        """The number of each word, for all documents in a row. ``hashed``: their hashes are wanted too, in every call."""
        if len(self.number) > HELD:
            self._clear()
        have, words = len(self.number), sum(map(len, docs))
        out = np.fromiter(map(self.number.__getitem__, chain.from_iterable(docs)), dtype=np.int64, count=words)
        new = list(islice(self.number, have, None))
        if new:
            flat, sizes = self.encoder.encode(new)
            while self.filled + len(flat) > len(self.ids):
                self.ids = np.r_[self.ids, np.zeros_like(self.ids)]
            while have + len(new) + 1 > len(self.starts):
                self.starts, self.hashes = np.r_[self.starts, np.zeros_like(self.starts)], np.r_[self.hashes, np.zeros_like(self.hashes)]
            self.ids[self.filled : self.filled + len(flat)] = flat
            if hashed:
                self.hashes[have : have + len(new)] = [_hash(w) for w in new]
            self.starts[have + 1 : have + 1 + len(new)] = self.filled + np.cumsum(sizes)
            self.filled += len(flat)
        return out

    def spread(self, numbers: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and classes of texts of ``words`` words each with the end behind each, the number of ids of
        each token (word or end), and of each text. The end has the id -1."""
        sizes = self.starts[numbers + 1] - self.starts[numbers]
        at = np.repeat(self.starts[numbers] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        last = np.cumsum(words)
        ids_before = np.r_[0, np.cumsum(sizes)][last]
        ids = np.insert(self.ids[at], ids_before, -1)
        classes = np.where(ids < 0, END, self.class_of[ids]).astype(np.int64)
        return ids, classes, np.insert(sizes, last, 1), np.diff(np.r_[0, ids_before]) + 1

    def shares(self, ids: np.ndarray, classes: np.ndarray, lengths: np.ndarray, pairs: Pairs) -> np.ndarray:
        """Log share of each id in its class, given the class before."""
        out = np.zeros(len(ids))
        at = np.flatnonzero((classes == _OTHER_START) | (classes == _OTHER_ON))
        before = _before(classes, lengths)[at]
        key = (before * len(self.class_of) + ids[at]).astype(pairs.keys.dtype)  # or the table is copied
        place = np.minimum(np.searchsorted(pairs.keys, key), max(0, len(pairs.keys) - 1))
        seen = np.where(pairs.keys[place] == key, pairs.counts[place], 0) if len(pairs.keys) else np.zeros(len(at))
        out[at] = np.log((seen + TRUST * np.exp(self.log_share[ids[at]])) / (pairs.totals[before, classes[at]] + TRUST))
        return out


def _exponentials(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """exp(rows - shift), its sum by row, and the shift: the greatest of all, which is found several times faster than
    one by row. Only if a row lies so far below it that its sum would lose digits, each row has its own."""
    one = np.ones(rows.shape[1], rows.dtype)
    shift = rows.max() if rows.size else rows.dtype.type(0)
    value = np.exp(rows - shift)
    total = value @ one
    if not rows.size or total.min() > 1e-20:
        return value, total, shift
    shift = rows.max(axis=1)
    value = np.exp(rows - shift[:, None])
    return value, value @ one, shift


def _sums(numbers: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """The sum of the rows of each number below ``count``: over sorted stretches, in half the time of adding row by row."""
    order = np.argsort(numbers.astype(np.uint16 if count <= 1 << 16 else np.int64), kind="stable")
    numbers = numbers[order]
    first = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]]) if len(numbers) else np.zeros(0, np.int64)
    out = np.zeros((count, rows.shape[1]), rows.dtype)
    if len(first):
        out[numbers[first]] = np.add.reduceat(rows.take(order, 0), first, axis=0)
    return out


class Attention:
    """One causal head over classes of ids. The next class is predicted in two steps, its group and then
    the class in the group, so that a place costs two short sums instead of one over all classes. A
    group holds classes that start a word (``starts``; the end among them) or others, not both."""

    def __init__(self, count: int, starts: np.ndarray, seed: int = 3):
        rng = np.random.default_rng(seed)
        make = lambda *shape: (0.1 * rng.standard_normal(shape)).astype(np.float32)
        kinds = [np.flatnonzero(starts), np.flatnonzero(~np.asarray(starts, dtype=bool))]
        chunks = [k[i : i + GROUP] for k in kinds for i in range(0, len(k), GROUP)]
        self.group, self.place = np.zeros(count, dtype=np.int64), np.zeros(count, dtype=np.int64)
        inner = np.full((count, len(chunks), GROUP), -30.0, dtype=np.float32)
        for g, members in enumerate(chunks):
            self.group[members], self.place[members] = g, np.arange(len(members))
            inner[:, g, : len(members)] = 0
        self.start_group = np.array([bool(starts[c[0]]) for c in chunks])
        self.p = {
            "q": make(count, WIDTH), "k": make(count, WIDTH), "v": make(count, WIDTH), "distance": np.zeros(WINDOW, np.float32),
            "u": make(WIDTH, len(chunks)), "before": np.zeros((count, len(chunks)), np.float32), "inner_u": make(len(chunks), WIDTH, GROUP), "inner_before": inner,
        }
        place = np.arange(WINDOW)
        self.gap = place[WINDOW - STRIDE :, None] - place[None, :]

    def attend(self, ids: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, tuple]:
        """What the last ``STRIDE`` places of each window gather from the places up to them. ``there``: no padding."""
        p = self.p
        asking = ids[:, WINDOW - STRIDE :]
        q, k, v = p["q"][asking], p["k"][ids], p["v"][ids]
        score = np.matmul(q, k.transpose(0, 2, 1)) * np.float32(1 / math.sqrt(WIDTH))
        score += np.where(self.gap >= 0, p["distance"][np.maximum(self.gap, 0)], np.float32(-1e9))
        score += np.where(there, np.float32(0), np.float32(-1e9))[:, None, :]
        score -= score.max(axis=2, keepdims=True)
        weight = np.exp(score, out=score)
        weight /= weight.sum(axis=2, keepdims=True)
        return np.matmul(weight, v), (asking, q, k, v, weight)

    def _logits(self, mixed: np.ndarray, asking: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Logits of the groups, logits inside the target's group, the target's group, and the places by group."""
        p, before, group = self.p, asking.ravel(), self.group[target.ravel()]
        flat = mixed.reshape(-1, WIDTH)
        outer = flat @ p["u"]
        outer += p["before"][before]
        inner = p["inner_before"][before, group]
        order = np.argsort(group, kind="stable")
        by_group = np.split(order, np.searchsorted(group[order], np.arange(1, len(self.start_group))))
        for g, own in enumerate(by_group):
            if len(own):
                inner[own] += flat[own] @ p["inner_u"][g]
        return outer, inner, group, by_group

    def _gathered(self, ids: np.ndarray, there: np.ndarray) -> np.ndarray:
        """What ``attend`` gathers, a row per scored place. Weights are divided by their sum behind the product."""
        p = self.p
        q, k, v = p["q"].take(ids[:, WINDOW - STRIDE :], 0), p["k"].take(ids, 0), p["v"].take(ids, 0)
        score = np.matmul(q * np.float32(1 / math.sqrt(WIDTH)), k.transpose(0, 2, 1))
        score += np.where(self.gap >= 0, p["distance"][np.maximum(self.gap, 0)], np.float32(-1e9))
        edge = np.flatnonzero(~there.all(axis=1))  # a text's first and last windows
        score[edge] += np.where(there[edge], np.float32(0), np.float32(-1e9))[:, None, :]
        weight, total, _ = _exponentials(score.reshape(-1, WINDOW))
        return np.matmul(weight.reshape(score.shape), v).reshape(-1, WIDTH) / total[:, None]

    def log_probabilities(self, ids: np.ndarray, there: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the target classes, and of any class that starts a word, at each scored place."""
        p, before, goal = self.p, ids[:, WINDOW - STRIDE :].ravel(), target.ravel()
        groups = len(self.start_group)
        flat, group = self._gathered(ids, there), self.group[goal]
        outer = flat @ p["u"]
        outer += p["before"].take(before, 0)
        chance, total, shift = _exponentials(outer)
        start = np.log(np.maximum(chance @ self.start_group.astype(chance.dtype), 1e-30) / total)
        log_p = outer[np.arange(len(outer)), group] - shift - np.log(total)
        # places in order of their target's group, so that a group is one stretch
        order = np.argsort(group.astype(np.int16), kind="stable")
        ends = np.cumsum(np.bincount(group, minlength=groups))
        flat, own = flat.take(order, 0), group[order]
        inner = p["inner_before"].reshape(-1, GROUP).take(before[order] * groups + own, 0)
        for g, (low, high) in enumerate(zip(np.r_[0, ends[:-1]], ends, strict=True)):
            if high > low:
                inner[low:high] += flat[low:high] @ p["inner_u"][g]
        _, total, shift = _exponentials(inner)
        log_p[order] += inner[np.arange(len(inner)), self.place[goal][order]] - shift - np.log(total)
        return log_p.reshape(target.shape), start.reshape(target.shape)

    def gradients(self, ids: np.ndarray, there: np.ndarray, target: np.ndarray, scored: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        mixed, (asking, q, k, v, weight) = self.attend(ids, there)
        outer, inner, group, by_group = self._logits(mixed, asking, target)
        p, before, flat = self.p, asking.ravel(), mixed.reshape(-1, WIDTH)
        row, count, share = np.arange(len(outer)), max(1, int(scored.sum())), scored.ravel()
        loss, errors = 0.0, []
        for logits, at in ((outer, group), (inner, self.place[target.ravel()])):
            probability, total, _ = _exponentials(logits)
            probability /= total[:, None]
            loss -= float((np.log(np.maximum(probability[row, at], 1e-30)) * share).sum() / count)
            probability[row, at] -= 1
            errors.append(probability * (share / np.float32(count))[:, None])
        d_outer, d_inner = errors
        g = {"u": flat.T @ d_outer, "inner_u": np.zeros_like(p["inner_u"])}
        g["inner_before"] = _sums(before * len(self.start_group) + group, d_inner, p["inner_before"].size // GROUP).reshape(p["inner_before"].shape)
        d_flat = d_outer @ p["u"].T
        for n, own in enumerate(by_group):
            if len(own):
                some = d_inner.take(own, 0)
                g["inner_u"][n] = flat.take(own, 0).T @ some
                d_flat[own] += some @ p["inner_u"][n].T
        d_mixed = d_flat.reshape(mixed.shape)
        d_v = np.matmul(weight.transpose(0, 2, 1), d_mixed)
        d_score = np.matmul(d_mixed, v.transpose(0, 2, 1))
        d_score -= np.einsum("ijk,ijk->ij", d_score, weight)[:, :, None]
        d_score *= weight
        g["distance"] = np.bincount(np.maximum(self.gap, 0).ravel(), weights=np.where(self.gap >= 0, d_score.sum(axis=0), 0).ravel(), minlength=WINDOW).astype(p["distance"].dtype)
        d_score *= np.float32(1 / math.sqrt(WIDTH))
        asked = _sums(before, np.hstack([d_outer, np.matmul(d_score, k).reshape(-1, WIDTH)]), len(p["q"]))
        g["before"], g["q"] = asked[:, :-WIDTH], asked[:, -WIDTH:]
        read = _sums(ids.ravel(), np.concatenate([np.matmul(d_score.transpose(0, 2, 1), q), d_v], axis=2).reshape(-1, 2 * WIDTH), len(p["k"]))
        g["k"], g["v"] = read[:, :WIDTH], read[:, WIDTH:]
        return loss, g


def windows(lengths: np.ndarray, some: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (all, or those numbered in ``some``) over texts that lie in a row (``lengths`` ids each): places of the inputs (the id
    before the one to predict; -1 stands for the start), which are there, and places of the targets (-1: none)."""
    per_text = -(-lengths // STRIDE)
    ends = np.cumsum(per_text)
    some = np.arange(int(per_text.sum())) if some is None else some
    text = np.searchsorted(ends, some, side="right")
    nth = some - (ends - per_text)[text]
    begin, size = (np.cumsum(lengths) - lengths)[text], lengths[text]
    target = nth[:, None] * STRIDE + np.arange(STRIDE)
    source = nth[:, None] * STRIDE - (WINDOW - STRIDE) + np.arange(WINDOW) - 1
    there = (source >= -1) & (source < size[:, None])
    return np.where(there & (source >= 0), begin[:, None] + source, -1), there, np.where(target < size[:, None], begin[:, None] + target, -1)


def fit(classes: np.ndarray, lengths: np.ndarray, pairs: np.ndarray, starts: np.ndarray, steps: int = STEPS) -> Attention:
    """Adam on windows from anywhere in the sampled texts; the table of the id before starts from the whole training
    part's ``pairs`` (class before x class)."""
    count = len(pairs)
    model = Attention(count, starts)
    if len(classes) == 0:
        return model
    number = int((-(-lengths // STRIDE)).sum())
    base = (pairs.sum(axis=0) + 0.5) / (pairs.sum() + 0.5 * count)
    smooth = (pairs + 5 * base) / (pairs.sum(axis=1, keepdims=True) + 5)
    groups = np.zeros((count, len(model.start_group)))
    np.add.at(groups.T, model.group, smooth.T)
    model.p["before"] = np.log(groups).astype(np.float32)
    model.p["inner_before"][:, model.group, model.place] = np.log(smooth / groups[:, model.group])
    padded = np.r_[classes, END].astype(np.int16)  # place -1
    rng = np.random.default_rng(5)
    first, second = ({n: np.zeros_like(x) for n, x in model.p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        source, there, target = windows(lengths, rng.integers(0, number, BATCH))
        _, g = model.gradients(padded[source].astype(np.int64), there, padded[target].astype(np.int64), (target >= 0).astype(np.float32))
        _adam(model.p, first, second, g, step, 0.01 * (1 - step / (steps + 1)))
    return model


def _adam(p: dict, first: dict, second: dict, g: dict, step: int, rate: float) -> None:
    """One step; the gradients ``g`` are used up."""
    for name, x in p.items():
        slow, change = 0.1 if name.endswith("before") else 1.0, g[name]
        first[name] *= 0.9
        first[name] += 0.1 * change
        np.square(change, out=change)
        change *= 0.01
        second[name] *= 0.99
        second[name] += change
        np.multiply(second[name], 1 / (1 - 0.99**step), out=change)
        np.sqrt(change, out=change)
        change += 1e-8
        np.divide(first[name], change, out=change)
        change *= slow * rate / (1 - 0.9**step)
        x -= change


def go_on(model: Attention, classes: np.ndarray, lengths: np.ndarray, seed: int) -> int:
    """One pass of Adam over every window of the texts, in random order. The number of windows."""
    number = int((-(-lengths // STRIDE)).sum())
    padded = np.r_[classes, END].astype(np.int16)  # place -1
    order, steps = np.random.default_rng(seed).permutation(number), -(-number // SHARD_BATCH)
    first, second = ({n: np.zeros_like(x) for n, x in model.p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        source, there, target = windows(lengths, order[(step - 1) * SHARD_BATCH : step * SHARD_BATCH])
        _, g = model.gradients(padded[source].astype(np.int64), there, padded[target].astype(np.int64), (target >= 0).astype(np.float32))
        _adam(model.p, first, second, g, step, SHARD_RATE * (1 - step / (steps + 1)))
    return number


def _count_pairs(subwords: tuple, count: int):
    """Rows (kind, key, n, classes) of the texts' neighbouring ids: class before and class (0), class before and an id
    without a class of its own (1); and of each text its ``deal``, number of ids and their classes (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, classes_n, held = Subwords(*subwords), np.zeros(count * count, dtype=np.int64), []

        def merged() -> list[tuple[np.ndarray, np.ndarray]]:
            keys, place = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return [(keys, np.bincount(place, weights=np.concatenate([n for _, n in held]), minlength=len(keys)).astype(np.int64))]

        def sent(kind: int, keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(keys), 1 << 18):
                k = keys[at : at + (1 << 18)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k, pa.int64()), pa.array(n[at : at + (1 << 18)], pa.int64())], names=["kind", "key", "n"]).append_column("classes", pa.nulls(len(k), pa.binary()))

        for batch in slices(batches, "text"):
            docs = [words_of(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            ids, classes, _, lengths = table.spread(table.numbers(docs), np.array([len(d) for d in docs], dtype=np.int64))
            before = _before(classes, lengths)
            classes_n += np.bincount(before * count + classes, minlength=count * count)
            ends = pa.py_buffer((2 * np.r_[0, np.cumsum(lengths)]).astype(np.int32))
            own = pa.Array.from_buffers(pa.binary(), len(docs), [None, ends, pa.py_buffer(classes.astype(np.int16))])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(docs), 2, np.int32)), batch.column("deal"), pa.array(lengths, pa.int64()), own], names=["kind", "key", "n", "classes"])
            at = np.flatnonzero((classes == _OTHER_START) | (classes == _OTHER_ON))
            held.append(np.unique(before[at] * len(table.class_of) + ids[at], return_counts=True))
            if sum(len(k) for k, _ in held) > HELD_PAIRS:
                held = merged()
                if len(held[0][0]) > HELD_PAIRS // 2:
                    yield from sent(1, *held.pop())
        if held:
            yield from sent(1, *merged()[0])
        there = np.flatnonzero(classes_n)
        yield from sent(0, there, classes_n[there])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's rows (kind, key, n) as a row of bytes for each kind and batch."""
    for batch in batches:
        kind, key, n = (batch.column(c).to_numpy() for c in ("kind", "key", "n"))
        for k in np.unique(kind):
            yield pa.RecordBatch.from_pydict({"kind": pa.array([k], pa.int32()), "keys": [key[kind == k].tobytes()], "counts": [n[kind == k].tobytes()]})


def read_classes(learn: DataFrame, subwords: tuple, count: int) -> DataFrame:
    """What one reading of all texts of ``learn`` gives: counts of pairs by task, and each text's classes; written."""
    dealt = learn.select("text", F.xxhash64(*learn.columns).alias("deal"))
    return write_through(dealt.mapInArrow(_count_pairs(subwords, count), "kind int, key bigint, n bigint, classes binary"), "read")


def count_pairs(learn: DataFrame, subwords: tuple, count: int, read: DataFrame | None = None) -> tuple[np.ndarray, Pairs]:
    """How often a class follows a class, and an id without a class of its own: in all texts of ``learn``."""
    read = read_classes(learn, subwords, count) if read is None else read
    counted = read.filter("kind < 2").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    counted = write_through(counted.mapInArrow(_packed, "kind int, keys binary, counts binary"), "pairs")
    classes = np.zeros(count * count)
    small = np.int32 if count * len(subwords[2]) < 1 << 31 else np.int64
    keys, counts = [np.zeros(0, small)], [np.zeros(0, np.float32)]
    for r in counted.toLocalIterator():  # at most count * count pairs of classes, and a pair for each class and id
        k, n = np.frombuffer(r.keys, dtype=np.int64), np.frombuffer(r.counts, dtype=np.int64)
        if r.kind == 0:
            classes[k] = n
        else:
            keys.append(k.astype(small))
            counts.append(n.astype(np.float32))
    flat, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(flat)
    classes = classes.reshape(count, count)
    return classes, Pairs(flat[order], n[order], classes[:, :3])


def _fitter(subwords: tuple, pairs: np.ndarray, starts: np.ndarray, steps: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Subwords(*subwords)
        classes, lengths = [np.zeros(0, np.int16)], [np.zeros(0, np.int64)]
        for batch in slices(batches, "text"):
            docs = [words_of(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            _, own, _, sizes = table.spread(table.numbers(docs), np.array([len(d) for d in docs], dtype=np.int64))
            classes.append(own.astype(np.int16))
            lengths.append(sizes)
        model = fit(np.concatenate(classes), np.concatenate(lengths), pairs, starts, steps)
        yield pa.RecordBatch.from_pydict({"state": pa.array([pickle.dumps(model.p)], pa.binary())})

    return run


def _shard_pass(starts: np.ndarray, network: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches)
        texts = sorted(zip(rows.column("key").to_pylist(), rows.column("classes").to_pylist(), strict=True))  # whatever order they came in
        model = Attention(len(starts), starts)
        model.p = {name: x.copy() for name, x in network.items()}
        lengths = np.array([len(t) // 2 for _, t in texts], dtype=np.int64)
        number = go_on(model, np.frombuffer(b"".join(t for _, t in texts), np.int16), lengths, rows.column("shard")[0].as_py())
        flat = np.concatenate([x.ravel() for x in model.p.values()]).astype(np.float32)
        parts = [flat[at : at + PART].tobytes() for at in range(0, len(flat), PART)]
        yield pa.RecordBatch.from_pydict({"place": pa.array(range(len(parts)), pa.int32()), "n": pa.array([number] * len(parts), pa.int64()), "part": pa.array(parts, pa.binary())})

    return run


def _mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mean of the shards' weights of one place, by their numbers of windows."""
    total, weights = 0, 0.0
    for batch in batches:
        place = batch.column("place")[0]
        for n, part in zip(batch.column("n").to_pylist(), batch.column("part").to_pylist(), strict=True):
            total, weights = total + n, weights + n * np.frombuffer(part, np.float32).astype(np.float64)
    yield pa.RecordBatch.from_pydict({"place": pa.array([place.as_py()], pa.int32()), "part": pa.array([(weights / total).astype(np.float32).tobytes()], pa.binary())})


def fit_shards(read: DataFrame, ids: int, starts: np.ndarray, network: dict) -> dict:
    """The network after a pass of every shard of the training part over all its windows. Shards follow from the texts
    and ids, so neither the partitions nor the order of the rows decide."""
    shards = max(1, math.ceil(ids / SHARD_IDS))
    dealt = read.filter("kind = 2").select(F.pmod("key", F.lit(shards)).cast("int").alias("shard"), "key", "classes").repartition(shards, "shard")
    ended = dealt.groupBy("shard").applyInArrow(_shard_pass(starts, network), "place int, n bigint, part binary")
    parts = ended.groupBy("place").applyInArrow(_mean, "place int, part binary").collect()  # as many bytes as the network has, whatever the number of shards
    if not parts:
        return network
    flat, out, at = np.frombuffer(b"".join(r.part for r in sorted(parts)), np.float32), {}, 0
    for name, x in network.items():
        out[name] = flat[at : at + x.size].reshape(x.shape).copy()
        at += x.size
    return out


def token_log_probabilities(model: Attention, classes: np.ndarray, shares: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural log probability of each token (word or end) given the text before it."""
    source, there, target = windows(lengths)
    padded = np.r_[classes, END].astype(np.int64)
    own, start = [np.zeros(0)], [np.zeros(0)]
    for at in range(0, len(source), 256):  # windows go through the texts in order, and so do their targets
        part = slice(at, at + 256)
        log_p, log_start = model.log_probabilities(padded.take(source[part], mode="wrap"), there[part], padded.take(target[part], mode="wrap"))
        real = target[part] >= 0
        own.append(log_p[real])
        start.append(log_start[real])
    own, start = np.concatenate(own), np.concatenate(start)
    own += shares
    firsts = np.cumsum(sizes) - sizes
    token = np.add.reduceat(own, firsts) - start[firsts]  # its ids, given that a token starts
    following = np.r_[firsts[1:], 0]
    token += np.where(classes[firsts] == END, 0.0, start[following])  # and that it ends there
    return np.minimum(token, 0.0)


def _used(numbers: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers (below ``most``) in order, and the place of each number among them, without a sort."""
    there = np.zeros(most, dtype=bool)
    there[numbers] = True
    return np.flatnonzero(there), (np.cumsum(there) - 1)[numbers]


_SCORED = "row bigint, key bigint, rare boolean, h bigint, log_model double, n_tokens bigint, n_known bigint, base double, score double"


def _scorer(subwords: tuple, starts: np.ndarray, state: tuple, frequent_h: np.ndarray, frequent_c: np.ndarray, total: float, ends: int):
    """One row per document for its frequent words and its end, one per occurrence of another word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, model = Subwords(*subwords), Attention(len(starts), starts)
        model.p, pairs = state
        part, row = TaskContext.get().partitionId() << 36, 0
        for batch in slices(batches, "text"):
            docs = [words_of(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            words = np.array([len(d) for d in docs], dtype=np.int64)
            numbers = table.numbers(docs, hashed=True)
            used, place = _used(numbers, len(table.number))
            hashes = table.hashes[used]
            at = np.minimum(np.searchsorted(frequent_h, hashes), max(0, len(frequent_h) - 1))
            is_frequent = frequent_h[at] == hashes if len(frequent_h) else np.zeros(len(used), bool)
            count = np.where(is_frequent, frequent_c[at], 0) if len(frequent_h) else np.zeros(len(used), np.int64)
            ids, classes, sizes, lengths = table.spread(numbers, words)
            log_model = token_log_probabilities(model, classes, table.shares(ids, classes, lengths, pairs), sizes, lengths)
            last = np.cumsum(words)
            token_count = np.insert(count[place], last, ends)
            known_here = np.insert(is_frequent[place], last, True)
            doc = np.repeat(np.arange(len(docs)), words + 1)
            share = (token_count + 0.5) / total
            base = np.log10(share) * known_here
            score = np.log10(MIX * np.exp(log_model) + (1 - MIX) * np.where(token_count > 0, share, 0.0) + 1e-300) * known_here
            sums = [np.bincount(doc, weights=w, minlength=len(docs)) for w in (known_here & (token_count > 0), base, score)]
            rare = np.flatnonzero(~known_here)
            rare_h = hashes[place][np.flatnonzero(~is_frequent[place])] if len(numbers) else np.zeros(0, np.int64)
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            rows = part + row + np.arange(len(docs))
            row += len(docs)
            zeros, nothing = np.zeros(len(rare)), np.zeros(len(rare), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.r_[rows, rows[doc[rare]]]),
                    pa.array(np.r_[keys, keys[doc[rare]]]),
                    pa.array(np.r_[np.zeros(len(docs), bool), np.ones(len(rare), bool)]),
                    pa.array(np.r_[rows, rare_h]),
                    pa.array(np.r_[np.zeros(len(docs)), log_model[rare]]),
                    pa.array(np.r_[words + 1, nothing]),
                    pa.array(np.r_[sums[0].astype(np.int64), nothing]),
                    pa.array(np.r_[sums[1], zeros]),
                    pa.array(np.r_[sums[2], zeros]),
                ],
                names=["row", "key", "rare", "h", "log_model", "n_tokens", "n_known", "base", "score"],
            )

    return run


def score_texts(docs: DataFrame, training: Column, path: str, pattern: str, steps: int = STEPS, sample: int = SAMPLE, frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.

    ``training``: of ``doc_id``, the rows to learn from. ``path``, ``pattern``: a byte-level rank file. A null or
    empty text is its end alone. Repeated rows and null ids are rows of their own. ``steps``, ``sample``: of the network's first
    fit, from which every window of the training rows is read once. Without training rows no
    token is known, ``base_score`` has N = V = 0, and the network is as it was set up."""
    spark = docs.sparkSession
    learn = keyed(docs.filter(training))
    counts = write_through(learn.select("text").mapInArrow(_count(path, pattern), "kind int, h bigint, n bigint").groupBy("kind", "h").agg(F.sum("n").alias("n")), "counts")
    words = counts.filter("kind = 0").select("h", "n")
    ends = (counts.filter("kind = 2").agg(F.sum("n")).first()[0]) or 0
    sums = words.agg(F.count("*").alias("v"), F.sum("n").alias("n")).first()
    tokens, distinct = (sums.n or 0) + ends, sums.v + (1 if ends else 0)
    total = tokens + 0.5 * (distinct + 1)

    # the least count of the words that travel: from a histogram, so that at most ``frequent`` words do
    bucket = F.floor(F.log2("n") * 8).cast("int")
    histogram = sorted(((r.b, r["count"]) for r in words.groupBy(bucket.alias("b")).count().collect()), reverse=True)  # some hundred rows
    chosen, room = None, frequent
    for b, n in histogram:
        if n > room:
            break
        room, chosen = room - n, b
    top = words.filter(bucket >= chosen) if chosen is not None else words.limit(0)
    travelling = top.toArrow()  # at most ``frequent`` words
    order = np.argsort(travelling.column("h").to_numpy())
    frequent_h, frequent_c = travelling.column("h").to_numpy()[order], travelling.column("n").to_numpy()[order]

    ranks = load_ranks(path)
    size = max(ranks.values()) + 1
    by_id = np.zeros(size, dtype=np.int64)
    for r in counts.filter("kind = 1").select("h", "n").toLocalIterator():  # a row per id of the vocabulary
        by_id[r.h] = r.n
    starts_word = np.zeros(size, dtype=bool)
    starts_word[[rank for token, rank in ranks.items() if token[:1] == b" "]] = True
    own = np.lexsort((np.arange(size), -by_id))[:CLASSES]
    class_of = np.where(starts_word, _OTHER_START, _OTHER_ON).astype(np.int16)
    log_share = np.zeros(size, dtype=np.float32)
    single = np.zeros(size, dtype=bool)
    single[own] = True
    class_of[own] = 3 + np.arange(len(own))
    for flag in (True, False):  # shares within the two classes of the others
        members = ~single & (starts_word == flag)
        log_share[members] = np.log((by_id[members] + 0.5) / (by_id[members].sum() + 0.5 * max(1, members.sum())))
    starts = np.r_[True, True, False, starts_word[own]]
    subwords = (path, pattern, class_of, log_share)

    read = read_classes(learn, subwords, len(starts))
    class_pairs, pairs = count_pairs(learn, subwords, len(starts), read)
    picked = sampled(learn, sample).repartition(1).sortWithinPartitions("key", "text")
    fitted = picked.select("text").mapInArrow(_fitter(subwords, class_pairs, starts, steps), "state binary").first()
    network = pickle.loads(fitted.state) if fitted else Attention(len(starts), starts).p  # as set up: nothing to learn from
    state = (fit_shards(read, int(by_id.sum()) + int(ends), starts, network), pairs)

    scored = keyed(docs).mapInArrow(_scorer(subwords, starts, state, frequent_h, frequent_c, float(total), int(ends)), _SCORED)
    rest = words.withColumnRenamed("n", "c") if chosen is None else words.filter(bucket < chosen).withColumnRenamed("n", "c")
    joined = scored.join(rest, "h", "left").withColumn("c", F.when(F.col("rare"), F.coalesce("c", F.lit(0))).otherwise(F.lit(0)))
    share = (F.col("c") + 0.5) / F.lit(float(total))
    mixed = F.lit(MIX) * F.exp("log_model") + F.when(F.col("c") > 0, (1 - F.lit(MIX)) * share).otherwise(0.0)
    per_text = joined.groupBy("row", "key").agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + (F.col("c") > 0).cast("bigint")).alias("n_known"),
        F.sum(F.col("base") + F.when(F.col("rare"), F.log10(share)).otherwise(0.0)).alias("base_score"),
        F.sum(F.col("score") + F.when(F.col("rare"), F.log10(mixed + F.lit(1e-300))).otherwise(0.0)).alias("score"),
    )
    return per_text.select(id_of(F.col("key")).alias("doc_id"), "n_tokens", "n_known", F.lit(int(tokens)).cast("bigint").alias("train_tokens"), "base_score", "score")
