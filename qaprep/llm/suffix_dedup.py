"""Repeated passages removed by a run-length compressed index.

Every byte is removed that a string of ``WINDOW`` bytes covers which also starts earlier in the corpus (a
smaller id, or the same document further ahead).

1. A window's anchor is the least hash of the 32-byte strings in it. Equal windows have equal anchors, so
   windows meet by their anchor alone. Neighbouring windows with one anchor form a context (at most
   ``2 * WINDOW`` bytes), and only its hashes travel: an anchor in about 35 bytes of text.
2. Rows of an anchor meet. An anchor seen once is done with. Of equal contexts all but the first are
   repeated whole. Equal contexts inside a task are merged first, so a passage that a third of all
   documents share arrives as a row per slice of text, not per document.
3. The texts of an anchor's different contexts are fetched, a bounded number of anchors per group. A
   group builds a suffix array and from it a run-length Burrows-Wheeler transform with the suffixes at
   the run ends as samples. Matching statistics (the longest match of each suffix with its neighbour in
   suffix order) are compared at the run heads only and streamed in text order in between, where each is
   one less than the one before. Neighbours that match in ``WINDOW`` bytes or more are one class; all of
   a class but its first place are marked.
   An anchor with more than ``MOST`` different contexts goes by single windows instead: a 128-bit hash of each,
   and a grouped minimum, which no number of contexts can overload.
4. Marked windows meet their document, which drops the bytes they cover.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaprep.llm.common import SpanHash, id_of, keyed, mix, slices, text_buffer
from qaprep.session import write_through

WINDOW = 100
GRAM = 32
#: Texts are dealt with in pieces of at most ``ANCHOR_BYTES`` bytes (and a window), so that a place fits these bits.
PLACE_BITS = 24
#: Bytes of text whose contexts are found at once; a Python worker takes some hundred bytes for each, two or three workers an executor.
ANCHOR_BYTES = 1 << 18
#: Different contexts of one anchor that an index takes.
MOST = 8192
#: Bytes of context texts in one index, on average; it takes some hundred bytes for each, too.
INDEX_BYTES = 1 << 18
#: A place is the copy (tells texts under one id apart) and the start in the text.
START_BITS = 40
_START = (1 << START_BITS) - 1


def _placed(docs: DataFrame) -> DataFrame:
    return keyed(docs).withColumn("copy", F.xxhash64("text").bitwiseAND(F.lit((1 << 22) - 1)))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[: len(values) - span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def contexts(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """row, start (in ``data``), windows, anchor hash and text hash of every context."""
    gram = min(GRAM, window)
    empty = np.zeros(0, np.int64)
    if len(data) < window:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    hashes = SpanHash(data)
    at = np.arange(len(data) - gram + 1)
    grams = mix(hashes.spans(at, at + gram))
    bits = np.uint64(PLACE_BITS)  # the least hash, leftmost on a tie
    least = _sliding_least((grams >> bits << bits) | at.astype(np.uint64), window - gram + 1)
    anchor = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    row = np.searchsorted(offsets, np.arange(len(anchor)), side="right") - 1
    valid = np.arange(len(anchor)) + window <= offsets[1:][row]
    head = valid.copy()
    head[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    starts = np.flatnonzero(head)
    counts = np.add.reduceat(valid.astype(np.int64), starts) if len(starts) else empty
    # a run of windows without a place of its own (text ends) lies behind the valid ones of its row
    return row[starts], starts, counts, grams[anchor[starts]], hashes.spans(starts, starts + counts - 1 + window)


_SEEN = "h bigint, g bigint, n int, key bigint, place bigint, again boolean"
_MARKS = "h bigint, key bigint, place bigint, n int, wanted boolean"


def _anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", ANCHOR_BYTES):
            data, offsets = text_buffer(batch.column("text"))
            # a text of any length is cut so that its windows are dealt with in turn
            step = ANCHOR_BYTES
            for base in range(0, max(1, len(data)), step):
                part = data[base : base + step + window - 1]
                inner = np.unique(np.clip(offsets - base, 0, len(part)))
                if len(inner) < 2:
                    continue
                row, start, n, h, g = contexts(part, inner, window)
                if len(row) == 0:
                    continue
                own = np.searchsorted(offsets, start + base, side="right") - 1
                key = batch.column("key").to_numpy(zero_copy_only=False)[own]
                copy = batch.column("copy").to_numpy(zero_copy_only=False)[own]
                place = (copy << START_BITS) | (start + base - offsets[own])
                h, g = h.view(np.int64), g.view(np.int64)
                order = np.lexsort((place, key, n, g, h))
                h, g, n, key, place = h[order], g[order], n[order], key[order], place[order]
                again = np.zeros(len(h), dtype=bool)
                again[1:] = (h[1:] == h[:-1]) & (g[1:] == g[:-1]) & (n[1:] == n[:-1]) & ((key[1:] != key[:-1]) | (place[1:] != place[:-1]))
                # repeats are marked as they are; they need no meeting and go anywhere
                h = np.where(again, mix(key.view(np.uint64) * np.uint64(31) + place.view(np.uint64)).view(np.int64), h)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(g), pa.array(n.astype(np.int32)), pa.array(key), pa.array(place), pa.array(again)], names=["h", "g", "n", "key", "place", "again"])

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (h, g, n, key, place): repeats of a context, and contexts whose texts are wanted."""

    def decide(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        again = rows["again"]
        marked = {c: rows[c][again] for c in ("h", "key", "place", "n")}
        h, g, n, key, place = (rows[c][~again] for c in ("h", "g", "n", "key", "place"))
        if len(h):
            new_h = np.r_[True, h[1:] != h[:-1]]
            new_c = new_h | np.r_[True, (g[1:] != g[:-1]) | (n[1:] != n[:-1])]
            first = np.flatnonzero(new_c)[np.cumsum(new_c) - 1]
            repeat = (key != key[first]) | (place != place[first])
            anchor = np.cumsum(new_h) - 1
            several = np.bincount(anchor, weights=new_c)[anchor] > 1
            wanted = new_c & several
            out = {c: np.concatenate([marked[c], v[repeat], v[wanted]]) for c, v in (("h", h), ("key", key), ("place", place), ("n", n))}
            flag = np.r_[np.zeros(len(marked["h"]) + int(repeat.sum()), bool), np.ones(int(wanted.sum()), bool)]
        else:
            out, flag = marked, np.zeros(len(marked["h"]), bool)
        return pa.RecordBatch.from_arrays([pa.array(out["h"], pa.int64()), pa.array(out["key"], pa.int64()), pa.array(out["place"], pa.int64()), pa.array(out["n"], pa.int32()), pa.array(flag)], names=["h", "key", "place", "n", "wanted"])

    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
        if held is not None:
            rows = {c: np.concatenate([held[c], v]) for c, v in rows.items()}
        cut = int(np.searchsorted(rows["h"], rows["h"][-1]))
        held = {c: v[cut:] for c, v in rows.items()}
        if cut:
            yield decide({c: v[:cut] for c, v in rows.items()})
    if held is not None:
        yield decide(held)


def _cut_contexts(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            h, key, place, n, texts = [], [], [], [], []
            for k, text, wanted in zip(batch.column("key").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                for w in wanted:
                    start = w["place"] & _START
                    h.append(w["h"])
                    key.append(k)
                    place.append(w["place"])
                    n.append(w["n"])
                    texts.append(text[start : start + w["n"] - 1 + window])
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(key, pa.int64()), pa.array(place, pa.int64()), pa.array(n, pa.int32()), pa.array(texts, pa.binary())], names=["h", "key", "place", "n", "text"])

    return run


class RunIndex:
    """Run-length Burrows-Wheeler transform of byte strings, each closed by an end mark of its own."""

    def __init__(self, texts: list[bytes]):
        lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        self.ends = np.cumsum(lengths) - 1
        symbols = np.ones(int(lengths.sum()), dtype=np.int64)
        body = np.ones(len(symbols), dtype=bool)
        body[self.ends] = False
        symbols[body] = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.int64) + 1
        symbols[~body] = 0
        self.symbols, size = symbols, len(symbols)
        # seven symbols in a number, blank behind an end mark; the mark's own number tells marks apart
        to_end = np.repeat(self.ends, lengths) - np.arange(size)
        padded = np.r_[symbols, np.zeros(7, np.int64)]
        first = np.zeros(size, dtype=np.int64)
        for i in range(7):
            first = (first << 9) | np.where(to_end >= i, padded[i : i + size], 0)
        text = np.repeat(np.arange(len(texts)), lengths)
        rank = np.unique(first, return_inverse=True)[1].astype(np.int64)
        rank = np.unique(rank * (len(texts) + 1) + np.where(to_end < 7, text + 1, 0), return_inverse=True)[1].astype(np.int64)
        span, longest = 7, int(lengths.max())
        while span < longest and (top := int(rank.max())) < size - 1:
            following = np.zeros(size, dtype=np.int64)
            following[: size - span] = rank[span:] + 1
            rank = np.unique(rank * (top + 2) + following, return_inverse=True)[1].astype(np.int64)
            span *= 2
        self.order = np.argsort(rank, kind="stable")
        last = np.where(self.order > 0, symbols[self.order - 1], 0)
        heads = np.flatnonzero(np.r_[True, (last[1:] != last[:-1]) | (last[1:] == 0)])  # end marks are all different
        self.run_heads = heads
        self.run_symbols = last[heads]
        self.head_samples = self.order[heads]
        self.end_samples = self.order[np.r_[heads[1:], size] - 1]

    def matches(self) -> np.ndarray:
        """For each place in the text the longest match with the suffix ahead in suffix order. Only run
        heads are compared, with the end sample of the run ahead; the rest is streamed in text order."""
        size = len(self.symbols)
        value = np.zeros(size, dtype=np.int64)
        known = np.zeros(size, dtype=bool)
        known[self.head_samples] = True
        padded = np.r_[self.symbols, np.zeros(20, np.int64)]
        a, b = self.head_samples[1:], self.end_samples[:-1]
        for at in range(0, len(a), 8192):
            x, y = a[at : at + 8192], b[at : at + 8192]
            found, alive = np.zeros(len(x), np.int64), np.arange(len(x))
            step = np.arange(20)
            while len(alive):  # an end mark matches nothing
                left, right = padded[(x + found)[alive, None] + step], padded[(y + found)[alive, None] + step]
                same = (left == right) & (left != 0)
                whole = same.all(axis=1)
                found[alive] += np.where(whole, 20, np.argmin(same, axis=1))
                alive = alive[whole]
            value[x] = found
        at = np.maximum.accumulate(np.where(known, np.arange(size), -1))
        return np.where(at >= 0, value[at] - (np.arange(size) - at), 0)


def marked_windows(texts: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Text number and start of each window that a text ahead, or the same text ahead, holds too."""
    index = RunIndex(texts)
    matches = index.matches()[index.order]
    starts = np.flatnonzero(np.r_[True, matches[1:] < window])
    first = np.minimum.reduceat(index.order, starts)
    members = np.diff(np.r_[starts, len(index.order)])
    marked = index.order[np.repeat((members > 1), members) & (index.order != np.repeat(first, members))]
    marked.sort()
    text = np.searchsorted(index.ends, marked)
    return text, marked - np.r_[0, index.ends[:-1] + 1][text]


def _index_group(window: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("place", "ascending")])
        keys, places = table.column("key").to_numpy(), table.column("place").to_numpy()
        table = table.filter(pa.array(np.r_[True, (keys[1:] != keys[:-1]) | (places[1:] != places[:-1])]))  # rows that repeat id and text
        text, start = marked_windows(table.column("text").to_pylist(), window)
        key, place = table.column("key").to_numpy()[text], table.column("place").to_numpy()[text] + start
        head = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (start[1:] != start[:-1] + 1)]) if len(text) else np.zeros(0, np.int64)
        n = np.diff(np.r_[head, len(text)])
        return pa.table({"key": pa.array(key[head], pa.int64()), "place": pa.array(place[head], pa.int64()), "n": pa.array(n.astype(np.int32), pa.int32())})

    return run


def _single_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = text_buffer(batch.column("text").cast(pa.binary()))
            n = batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(n)), n)
            inner = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            at = offsets[row] + inner
            one, two = SpanHash(data).spans(at, at + window), SpanHash(data ^ np.uint8(0x5A)).spans(at, at + window)
            key, place = batch.column("key").to_numpy(zero_copy_only=False)[row], batch.column("place").to_numpy(zero_copy_only=False)[row] + inner
            yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(key), pa.array(place)], names=["one", "two", "key", "place"])

    return run


def repeated_windows(docs: DataFrame, window: int = WINDOW, most: int = MOST) -> DataFrame:
    """``key, place, n``: runs of n windows that also start earlier."""
    rows = _placed(docs)
    seen = rows.mapInArrow(_anchors(window), _SEEN)
    met = seen.repartition("h").sortWithinPartitions("h", "g", "n", "key", "place").mapInArrow(_meet, _MARKS)
    met = write_through(met, "anchors")
    marks = met.filter("NOT wanted").select("key", "place", "n")
    wanted = met.filter("wanted")
    copy = F.shiftright("place", START_BITS)
    by_doc = wanted.groupBy("key", copy.alias("copy")).agg(F.collect_list(F.struct("h", "place", "n")).alias("wanted"))  # bounded by the document's length
    fetched = write_through(rows.join(write_through(by_doc, "wanted"), ["key", "copy"]).mapInArrow(_cut_contexts(window), "h bigint, key bigint, place bigint, n int, text binary"), "contexts")
    sizes = fetched.groupBy("h").agg(F.count("*").alias("count"), F.sum(F.octet_length("text")).alias("bytes"))
    busy = write_through(sizes.filter(F.col("count") > most).select("h"), "busy")
    total = fetched.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-int(total) // INDEX_BYTES))
    indexed = fetched.join(busy, "h", "left_anti").withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(groups)))
    found = indexed.groupBy("bucket").applyInArrow(_index_group(window), "key bigint, place bigint, n int")
    out = marks.union(found)
    if not busy.isEmpty():
        single = write_through(fetched.join(busy, "h", "left_semi").mapInArrow(_single_windows(window), "one bigint, two bigint, key bigint, place bigint"), "windows")
        first = write_through(single.groupBy("one", "two").agg(F.min(F.struct("key", "place")).alias("first"), F.count("*").alias("count")).filter("count > 1"), "first")
        later = single.join(first.select("one", "two", "first"), ["one", "two"]).filter(F.struct("key", "place") != F.col("first"))
        out = out.union(later.select("key", "place", F.lit(1).alias("n")))
    return write_through(out, "repeats")


def _remove(window: int, keep: int, as_text: bool = False):
    """``keep``: columns of the input that go on ahead of the results."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, removed, spans, kept = [], [], [], []
            for text, runs in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("runs").to_pylist(), strict=True):
                sizes.append(len(text))
                if not runs:
                    removed.append(0)
                    spans.append(0)
                    kept.append(text)
                    continue
                change = np.zeros(len(text) + 1, dtype=np.int64)
                starts = np.array([r["place"] & _START for r in runs])
                np.add.at(change, starts, 1)
                np.add.at(change, starts + np.array([r["n"] for r in runs]) - 1 + window, -1)
                gone = np.cumsum(change[:-1]) > 0
                removed.append(int(gone.sum()))
                spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                kept.append(np.frombuffer(text, dtype=np.uint8)[~gone].tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(keep)), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary())], names=[*batch.schema.names[:keep], "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def _runs_by_doc(repeats: DataFrame) -> DataFrame:
    return repeats.groupBy("key", F.shiftright("place", START_BITS).alias("copy")).agg(F.collect_list(F.struct("place", "n")).alias("runs"))  # bounded by the document's length


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes that are left) for every row of ``docs``.

    Null counts as empty; texts shorter than ``window`` bytes lose nothing. Among rows that share an id the
    order is by text; rows that repeat id and text are one document and all get its result. A null
    id comes before all others. An empty table gives an empty result."""
    runs = write_through(_runs_by_doc(repeated_windows(docs, window)), "runs")
    joined = _placed(docs).join(runs, ["key", "copy"], "left").select("key", "text", "runs")
    out = joined.mapInArrow(_remove(window, 1), "key bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    return out.select(id_of(F.col("key")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")


def cut_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text`` (and ``n_chars`` counted anew, if there is such
    a column). A character that a cut splits goes whole. Texts that are cut to nothing go, empty ones
    that came in stay."""
    runs = write_through(_runs_by_doc(repeated_windows(docs, window)), "runs")
    named = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)], *[F.col(f"`{c}`").alias(c) for c in ("doc_id", "text")])
    plain = named.withColumns({"key": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))), "copy": F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).bitwiseAND(F.lit((1 << 22) - 1))})
    width = len(docs.columns)
    joined = plain.join(runs, ["key", "copy"], "left").select(*[f"c{i}" for i in range(width)], F.coalesce("text", F.lit("")).alias("text"), "runs")
    fields = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    out = joined.mapInArrow(_remove(window, width, as_text=True), f"{fields}, n_bytes bigint, n_removed bigint, n_spans bigint, kept string").filter("n_removed = 0 OR n_removed < n_bytes")
    cut = F.col("n_removed") > 0
    fresh = {"text": F.col("kept"), "n_chars": F.length("kept").cast("bigint")}
    return out.select(*[(F.when(cut, fresh[c]).otherwise(F.col(f"c{i}")) if c in fresh else F.col(f"c{i}")).alias(c) for i, c in enumerate(docs.columns)])
