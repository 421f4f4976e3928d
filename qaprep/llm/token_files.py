"""Token ids in files: a shared zstandard dictionary, one frame per document, and an offset index.

A folder holds two tables. ``dictionary``: its bytes and their hash. ``shards``: rows in ascending document
order, each with a payload of compressed documents (``SHARD`` bytes or one document) and the index
of that payload: document, place and size of its frame, number of its ids. Every shard names the hash
of the dictionary it needs, and the ids its partition holds ahead of it. Both are written with Spark's
committer, so a task that is lost or run twice leaves nothing half done, on any store Spark writes to.
One document is read from its shard by the index, without any other frame being decompressed.

The dictionary is trained on the id arrays of ``SAMPLE`` documents (the smallest by a hash of id
and text, the first ``SAMPLE_IDS`` ids of each); it changes the size of the files only, never what they hold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaprep.llm.common import id_of, keyed, sampled, slices
from qaprep.llm.tokens import WordEncoder

END_ID = 2
SHARD = 512 << 10
SAMPLE = 400
SAMPLE_IDS = 8192
DICTIONARY = 64 << 10

_INDEX = pa.list_(pa.struct([("key", pa.int64()), ("offset", pa.int64()), ("size", pa.int64()), ("n_tokens", pa.int64())]))
_SHARDS = "part int, shard int, low bigint, high bigint, ids_before bigint, n_tokens bigint, width int, dictionary string, payload binary, documents array<struct<key: bigint, offset: bigint, size: bigint, n_tokens: bigint>>"


def _train(path: str, end_id: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encoder, samples = None, []
        for batch in slices(batches, "text"):
            encoder = encoder or WordEncoder(path, spaced=False)
            end = np.array([end_id], dtype=encoder.dtype).tobytes()
            samples += [(ids + end)[: SAMPLE_IDS * encoder.dtype.itemsize] for ids in encoder.encode(batch.column("text").to_pylist())]
        try:
            trained = zstandard.train_dictionary(size, samples).as_bytes() if samples else b""
        except zstandard.ZstdError:  # too few or too short documents to learn from
            trained = b""
        yield pa.RecordBatch.from_pydict({"bytes": pa.array([trained], pa.binary())})

    return run


def _write(path: str, end_id: int, trained: bytes, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        shared = zstandard.ZstdCompressionDict(trained) if trained else None
        packer = zstandard.ZstdCompressor(level=level, dict_data=shared, write_content_size=True)
        encoder = WordEncoder(path, spaced=False)
        end = np.array([end_id], dtype=encoder.dtype).tobytes()
        width, name, part = encoder.dtype.itemsize, hashlib.sha256(trained).hexdigest(), TaskContext.get().partitionId()
        frames: list[bytes] = []
        index: list[dict] = []
        number = before = filled = 0

        def shard() -> pa.RecordBatch:
            count = sum(d["n_tokens"] for d in index)
            columns = [[part], [number], [index[0]["key"]], [index[-1]["key"]], [before], [count], [width], [name], [b"".join(frames)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)] + [pa.array([index], _INDEX)], names=["part", "shard", "low", "high", "ids_before", "n_tokens", "width", "dictionary", "payload", "documents"])

        for batch in slices(batches, "text"):
            for key, ids in zip(batch.column("key").to_pylist(), encoder.encode(batch.column("text").to_pylist()), strict=True):
                frame = packer.compress(ids + end)
                if index and filled + len(frame) > SHARD:
                    yield shard()
                    before += sum(d["n_tokens"] for d in index)
                    frames, index, number, filled = [], [], number + 1, 0
                index.append({"key": key, "offset": filled, "size": len(frame), "n_tokens": len(ids) // width + 1})
                frames.append(frame)
                filled += len(frame)
        if index:
            yield shard()

    return run


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int = END_ID, level: int = 3, dictionary: int = DICTIONARY) -> None:
    """Encode every whole text, add ``end_id``, and write the ids to ``folder`` in ascending ``doc_id`` order.

    A null or empty text is the end id alone. A null id comes first; repeated rows are documents of their
    own, in the order of their texts' hashes. An empty table gives a folder without shards."""
    spark = docs.sparkSession
    rows = keyed(docs)
    sample = sampled(rows, SAMPLE).repartition(1).sortWithinPartitions("key", "text")
    trained = sample.mapInArrow(_train(path, end_id, dictionary), "bytes binary").filter("length(bytes) > 0").first()
    raw = bytes(trained.bytes) if trained else b""
    spark.createDataFrame([(hashlib.sha256(raw).hexdigest(), raw)], "dictionary string, bytes binary").coalesce(1).write.parquet(f"{folder}/dictionary")
    tie = F.xxhash64("text")
    dealt = rows.repartitionByRange("key", tie).sortWithinPartitions("key", tie)
    dealt.mapInArrow(_write(path, end_id, raw, level), _SHARDS).write.parquet(f"{folder}/shards")


def _read(trained: bytes, wanted: list[int] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        name = hashlib.sha256(trained).hexdigest()
        opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
        chosen = None if wanted is None else set(wanted)
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary"] != name:
                    raise ValueError(f"the shard needs the dictionary {row['dictionary']}, the folder has {name}")
                keys, starts, counts, ids, start = [], [], [], [], row["ids_before"]
                for entry in row["documents"]:
                    if chosen is None or entry["key"] in chosen:
                        raw = opener.decompress(row["payload"][entry["offset"] : entry["offset"] + entry["size"]])
                        own = np.frombuffer(raw, dtype=f"<u{row['width']}")
                        keys.append(entry["key"])
                        starts.append(start)
                        counts.append(len(own))
                        ids.append(own.astype("<u4").tobytes())
                    start += entry["n_tokens"]
                yield pa.RecordBatch.from_arrays([pa.array([row["part"]] * len(keys), pa.int32()), pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], names=["part", "key", "inner", "n_tokens", "ids"])

    return run


def read_tokens(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian unsigned 32-bit integers) of all documents, or of a short
    list of them; ``start`` is the number of ids of all documents before."""
    row = spark.read.parquet(f"{folder}/dictionary").first()
    shards = spark.read.schema(_SHARDS).parquet(f"{folder}/shards")
    totals = sorted((r.part, r.n) for r in shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())  # a row per partition
    offsets, before = [], 0
    for part, n in totals:
        offsets.append((part, before))
        before += n
    if doc_ids is not None:
        shards = shards.filter(" OR ".join(f"low <= {int(i)} AND high >= {int(i)}" for i in doc_ids) or "false")
    rows = shards.select("part", "ids_before", "width", "dictionary", "payload", "documents").mapInArrow(_read(bytes(row.bytes), doc_ids), "part int, key bigint, inner bigint, n_tokens bigint, ids binary")
    placed = rows.join(F.broadcast(spark.createDataFrame(offsets, "part int, before bigint")), "part")
    return placed.select(id_of(F.col("key")).alias("doc_id"), (F.col("before") + F.col("inner")).alias("start"), "n_tokens", "ids")
