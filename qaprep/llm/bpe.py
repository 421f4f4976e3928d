"""Byte-level BPE with a rank file, by padded matrices.

The pattern cuts a text into pieces. The distinct new pieces of a slice of texts are merged together: pieces of
about one length form the rows of a matrix of token ids. In each round every row merges its leftmost
pair of least rank; the pairs' ranks come from an open-addressing hash table in numpy, only the two
pairs beside a merge are looked up again, the row closes up by one place, and rows that are done leave the
matrix. Pieces beyond ``LONGEST`` bytes, for which rounds over a matrix would cost the square of their
length, are merged with a linked list and a heap, by the same rule. Nothing is ever cut off.
"""

from __future__ import annotations

import binascii
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaprep.llm.common import id_of, keyed, mix, slices

LONGEST = 256
#: Pieces kept per task. Beyond half of it the table becomes the older one, from which pieces still in use come back.
KEPT = 300_000
_NONE = np.int64(1 << 40)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as source:
        fields = source.read().split()
    return dict(zip(map(binascii.a2b_base64, fields[::2]), map(int, fields[1::2]), strict=True))


class PairTable:
    """Open addressing with linear probing: (left id, right id) to the id of both together."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, both = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    both.append(rank)
        keys = (np.array(left, dtype=np.uint64) << np.uint64(32)) | np.array(right, dtype=np.uint64)
        values = np.array(both, dtype=np.int64)
        size = 1 << max(4, int(2 * len(keys)).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys = np.full(size, np.iinfo(np.uint64).max, dtype=np.uint64)
        self.values = np.full(size, _NONE, dtype=np.int64)
        slot, left_over = (mix(keys) & self.mask).astype(np.int64), np.arange(len(keys))
        while len(left_over):  # each round the first comer of a free slot takes it, the others move on
            free = self.keys[slot[left_over]] == np.iinfo(np.uint64).max
            claim = left_over[free]
            _, first = np.unique(slot[claim], return_index=True)
            won = claim[first]
            self.keys[slot[won]], self.values[slot[won]] = keys[won], values[won]
            left_over = np.setdiff1d(left_over, won, assume_unique=True)
            slot[left_over] = (slot[left_over] + 1) & (size - 1)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``_NONE`` where there is none (or a negative id)."""
        real = np.flatnonzero((left >= 0) & (right >= 0))
        out = np.full(len(left), _NONE, dtype=np.int64)
        keys = (left[real].astype(np.uint64) << np.uint64(32)) | right[real].astype(np.uint64)
        slot = (mix(keys) & self.mask).astype(np.int64)
        while len(real):
            there = self.keys[slot]
            hit = there == keys
            out[real[hit]] = self.values[slot[hit]]
            on = ~hit & (there != np.iinfo(np.uint64).max)
            real, keys, slot = real[on], keys[on], (slot[on] + 1) & int(self.mask)
        return out


class Encoder:
    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks = load_ranks(path)
        self.pairs = PairTable(self.ranks)
        self.pattern = regex.compile(pattern)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = np.array([whole])
            elif len(piece) > LONGEST:
                out[i] = self._merge_long(piece)
            else:
                buckets.setdefault(4 if len(piece) <= 4 else 8 * -(-len(piece) // 8), []).append(i)
        for width, members in buckets.items():
            for at in range(0, len(members), 16384):
                some = members[at : at + 16384]
                for i, ids in zip(some, self._merge_rows([pieces[i] for i in some], width), strict=True):
                    out[i] = ids
        return out

    def _merge_rows(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        rows = np.full((len(pieces), width + 1), -1, dtype=np.int64)  # one place of padding at the end
        lengths = np.array([len(p) for p in pieces])
        flat = self.single[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        rows[np.arange(width + 1) < lengths[:, None]] = flat
        done: list[np.ndarray | None] = [None] * len(pieces)
        left = np.arange(len(pieces))
        rank = self.pairs.find(rows[:, :-1].ravel(), rows[:, 1:].ravel()).reshape(len(rows), width)
        places = np.arange(width + 1)
        while len(left):
            at = rank.argmin(axis=1)  # the leftmost of the least
            row = np.arange(len(left))
            best = rank[row, at]
            over = best == _NONE
            if over.any():
                for i in np.flatnonzero(over):
                    done[left[i]] = rows[i][rows[i] >= 0]
                stay = ~over
                left, rows, rank, at, best = left[stay], rows[stay], rank[stay], at[stay], best[stay]
                row = np.arange(len(left))
                if len(left) == 0:
                    break
            rows[row, at] = best
            # close up behind the merge
            source = np.minimum(places + (places > at[:, None]), rows.shape[1] - 1)
            rows = np.take_along_axis(rows, source, axis=1)
            rows[:, -1] = -1
            rank = np.take_along_axis(rank, np.minimum(source[:, :-1], rank.shape[1] - 1), axis=1)
            rank[:, -1] = _NONE
            rank[row, at] = self.pairs.find(rows[row, at], rows[row, at + 1])
            ahead = np.flatnonzero(at > 0)
            rank[ahead, at[ahead] - 1] = self.pairs.find(rows[ahead, at[ahead] - 1], rows[ahead, at[ahead]])
        return done

    def _merge_long(self, piece: bytes) -> np.ndarray:
        ids = self.single[np.frombuffer(piece, dtype=np.uint8)].tolist()
        size = len(ids)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        first = self.pairs.find(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(int(first[i]), i, ids[i], ids[i + 1]) for i in np.flatnonzero(first < _NONE).tolist()]
        heapq.heapify(heap)
        alive = [True] * size
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or ids[i] != a or j >= size or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = rank, False, after[j]
            if after[j] < size:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < size:
                    found = int(self.pairs.find(np.array([ids[left]]), np.array([ids[right]]))[0])
                    if found < _NONE:
                        heapq.heappush(heap, (found, left, ids[left], ids[right]))
        return np.array([x for x, there in zip(ids, alive, strict=True) if there])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts = [self.pattern.findall(t) for t in texts]
        if len(self.known) > KEPT // 2:
            self.known, self.older = {}, self.known
        missing = set().union(*parts).difference(self.known)
        back = missing.intersection(self.older)
        self.known.update(zip(back, map(self.older.__getitem__, back), strict=True))
        new = list(missing.difference(back))
        self.known.update(zip(new, (ids.astype("<i4").tobytes() for ids in self.merge([p.encode() for p in new])), strict=True))
        return [np.frombuffer(b"".join(map(self.known.__getitem__, own)), dtype="<i4") for own in parts]


def _id_lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.r_[0, np.cumsum([len(a) for a in arrays])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int32), pa.int32()))


def _encode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, pattern)
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("key"), _id_lists(encoder.encode(batch.column("text").to_pylist()))], names=["key", "ids"])

    return run


def _decode(path: str, keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(path)
        by_rank = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            by_rank[rank] = token
        vocabulary = pa.array(by_rank, pa.large_binary())
        for batch in batches:
            ids = batch.column("ids")
            lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
            tokens = pa.LargeListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths, dtype=np.int64)]), vocabulary.take(ids.flatten()))
            decoded = pc.if_else(ids.is_valid(), pc.binary_join(tokens, pa.scalar(b"", pa.large_binary())), None).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(keep)), decoded], names=[*batch.schema.names[:keep], "decoded"])

    return run


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` of every row: the ids of the whole text, without special tokens.

    A null or empty text has no ids (an empty array). Repeated rows and null ids are rows like any other;
    an empty table gives no rows. ``path``: the rank file; ``pattern``: cuts a text into pieces."""
    return keyed(docs).mapInArrow(_encode(path, pattern), "key bigint, ids array<int>").select(id_of(F.col("key")).alias("doc_id"), "ids")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``tokens`` with ``decoded``, the bytes its ``ids`` stand for (null for null ids)."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema.fields)
    return tokens.mapInArrow(_decode(path, len(tokens.columns)), f"{fields}, decoded binary")
