"""Packing of tokenised documents into sequences by first-fit decreasing.

A document's ids (and the end id) are cut into pieces of at most ``length``. Pieces are dealt at random, by
a hash of their document and start, to groups of about ``group`` pieces. Each group is packed for itself:
pieces in falling order of size, each into the first sequence with room, found by walking down a
tournament tree whose nodes hold the largest room below them. A group is a bounded number of bounded
pieces, so it fits a task whatever the number or the length of the documents; a lost task is done again
with the same result. The few sequences a group leaves partly filled are levelled: pieces of the emptiest
are cut to fill the others, and the last one is cut at powers of two, where no padding is due.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaprep.llm.common import id_of, keyed, slices
from qaprep.llm.tokens import WordEncoder

LENGTH = 2048
GROUP = 4096
END_ID = 1


def first_fit_decreasing(sizes: np.ndarray, room: int) -> np.ndarray:
    """The bin of each size: sizes in falling order (ties as given), each into the first bin it fits."""
    order = np.argsort(-sizes, kind="stable")
    bins = np.empty(len(sizes), dtype=np.int64)
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    tree = [room] * (2 * leaves)
    for item in order.tolist():
        size, node = int(sizes[item]), 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[item] = node - leaves
        tree[node] -= size
        node //= 2
        while node:
            best = tree[2 * node] if tree[2 * node] >= tree[2 * node + 1] else tree[2 * node + 1]
            if tree[node] == best:
                break
            tree[node] = best
            node //= 2
    return bins


def level(bins: list[list[tuple[int, int, int]]], room: int) -> list[list[tuple[int, int, int]]]:
    """Bins of pieces (item, from, to) that are partly filled, packed again by cutting: the fullest bin is
    filled from the emptiest, and the last is cut into powers of two."""
    bins = sorted(bins, key=lambda b: -sum(t - f for _, f, t in b))
    out = []
    while bins:
        target = bins.pop(0)
        free = room - sum(t - f for _, f, t in target)
        while free and bins:
            item, start, stop = bins[-1].pop()
            taken = min(free, stop - start)
            target.append((item, start, start + taken))
            free -= taken
            if start + taken < stop:
                bins[-1].append((item, start + taken, stop))
            if not bins[-1]:
                bins.pop()
        if not free:
            out.append(target)
            continue
        while target:  # the last one
            size = sum(t - f for _, f, t in target)
            want, own = 1 << (size.bit_length() - 1), []
            while want:
                item, start, stop = target.pop(0)
                taken = min(want, stop - start)
                own.append((item, start, start + taken))
                want -= taken
                if start + taken < stop:
                    target.insert(0, (item, start + taken, stop))
            out.append(own)
    return out


def _pieces(path: str, length: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path, spaced=True)
        dtype = encoder.dtype if end_id < 1 << (8 * encoder.dtype.itemsize) else np.dtype("<u4")
        end = np.array([end_id], dtype=dtype).tobytes()
        step = length * dtype.itemsize
        for batch in slices(batches, "text"):
            keys, starts, totals, pieces = [], [], [], []
            for key, ids in zip(batch.column("key").to_pylist(), encoder.encode(batch.column("text").to_pylist()), strict=True):
                raw = (ids if dtype == encoder.dtype else np.frombuffer(ids, encoder.dtype).astype(dtype).tobytes()) + end
                for at in range(0, len(raw), step):
                    keys.append(key)
                    starts.append(at // dtype.itemsize)
                    totals.append(len(raw) // dtype.itemsize)
                    pieces.append(raw[at : at + step])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), pa.array(totals, pa.int64()), pa.array([dtype.itemsize] * len(keys), pa.int32()), pa.array(pieces, pa.binary())], names=["key", "start", "doc_tokens", "width", "ids"])

    return run


_PACKED = "key bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"


def _pack_group(length: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("start", "ascending"), ("ids", "ascending")])
        width = table.column("width")[0].as_py()
        sizes = (pc.binary_length(table.column("ids")).to_numpy() // width).astype(np.int64)
        bins = first_fit_decreasing(sizes, length)
        packed: list[list[tuple[int, int, int]]] = [[] for _ in range(int(bins.max()) + 1)]
        for item in np.argsort(-sizes, kind="stable").tolist():
            packed[bins[item]].append((item, 0, int(sizes[item])))
        filled = np.bincount(bins, weights=sizes)
        full = [b for b, n in zip(packed, filled, strict=True) if n == length]
        packed = full + level([b for b, n in zip(packed, filled, strict=True) if n < length], length)
        keys, starts, totals = (table.column(c).to_pylist() for c in ("key", "start", "doc_tokens"))
        raw, base = table.column("ids").to_pylist(), table.column("bucket")[0].as_py() << 32
        rows: list[tuple] = []
        for number, pieces in enumerate(packed):
            offset = 0
            for item, a, b in pieces:
                ids = np.frombuffer(raw[item], dtype=f"<u{width}")[a:b].astype("<u4").tobytes()
                rows.append((keys[item], starts[item] + a, b - a, totals[item], base + number, offset, ids))
                offset += b - a
        kinds = [pa.int64()] * 6 + [pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["key", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    return run


def pack(docs: DataFrame, path: str, length: int = LENGTH, group: int = GROUP, end_id: int = END_ID) -> DataFrame:
    """``doc_id, start, length, doc_tokens, sequence_id, offset, ids`` of every piece.

    ``ids`` are the piece's ids as little-endian unsigned 32-bit integers, ``start`` its place in the
    document, ``offset`` its place in the sequence. A null or empty text is the end id alone. Repeated rows
    and null ids are documents of their own; an empty table gives no pieces."""
    rows = keyed(docs)
    most = rows.agg(F.sum(F.ceil((F.octet_length("text") + 1) / F.lit(length)))).first()[0] or 0  # of the pieces
    groups = max(1, -(-int(most) // group))
    pieces = rows.mapInArrow(_pieces(path, length, end_id), "key bigint, start bigint, doc_tokens bigint, width int, ids binary")
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("key", "start", "doc_tokens", F.crc32("ids")), F.lit(groups)))
    packed = dealt.groupBy("bucket").applyInArrow(_pack_group(length), _PACKED)
    return packed.select(id_of(F.col("key")).alias("doc_id"), "start", "length", "doc_tokens", "sequence_id", "offset", "ids")


def unpack(ids: bytes) -> list[int]:
    """The ids of a piece."""
    return np.frombuffer(ids, dtype="<u4").tolist()


def checksum(ids: list[int]) -> int:
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())
