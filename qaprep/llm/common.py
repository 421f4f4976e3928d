"""Helpers of the operators in this package: keys, Arrow batches, links and components.

Conventions of every operator here. A null text counts as empty. ``doc_id`` may be null or repeated: a
null id is an id of its own (``NO_ID`` inside, null again in results). Only the columns an operator
names are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qaprep.session import configure, write_through

NO_ID = -(1 << 63)
#: Rows go to Python in batches of at most this many rows and about this size; ``slices`` cuts them again.
ROWS_PER_BATCH = "4000"
BYTES_PER_BATCH = "16m"
SLICE_BYTES = 4 << 20


def session(spark: SparkSession) -> SparkSession:
    """The settings of the library, and Arrow batches that stay small with long texts."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_PER_BATCH)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return session(spark).read.parquet(f"{folder}/{name}.parquet")


def keyed(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key`` (never null) and ``text`` (never null) of every row."""
    return docs.select(F.coalesce(F.col(key).cast("bigint"), F.lit(NO_ID)).alias("key"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def sampled(rows: DataFrame, count: int) -> DataFrame:
    """The ``count`` rows of ``keyed`` rows with the smallest hash of key and text. Only hashes are sorted; the
    texts join the chosen ones. A row that is repeated any number of times is read once."""
    order = F.xxhash64("key", "text")
    chosen = rows.select("key", order.alias("_order")).distinct().orderBy("_order", "key").limit(count)
    found = rows.withColumn("_order", order).join(F.broadcast(chosen), ["key", "_order"])  # at most ``count`` rows
    return found.groupBy("key", "_order").agg(F.min("text").alias("text")).drop("_order")


def id_of(key: Column) -> Column:
    """The id a key stands for: null for ``NO_ID``."""
    return F.when(key != F.lit(NO_ID), key)


def crc32_of_id(doc_id: Column) -> Column:
    """crc32 of the decimal id; that of the empty text when the id is null."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column in one array, and the offsets of its rows."""
    column = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a slice have at most ``most`` bytes, or it has one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(lengths)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all other bytes as they are."""
    return data + (((data - np.uint8(65)) < 26).astype(np.uint8) << 5)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs without white space, and the number of words before each row."""
    solid = np.zeros(len(data) + 1, dtype=bool)
    solid[:-1] = ~_SPACE[data]
    follows = np.zeros(len(data) + 1, dtype=bool)
    follows[1:] = solid[:-1]
    follows[offsets] = False
    starts = np.flatnonzero(solid & ~follows)
    goes_on = (solid & follows)[1:]
    ends = np.flatnonzero(solid[:-1] & ~goes_on) + 1
    return starts, ends, np.searchsorted(starts, offsets)


MULTIPLIER = 0x9E3779B97F4A7C15 | 5
_WRAP = (1 << 64) - 1


def powers(count: int, inverse: bool = False) -> np.ndarray:
    """1, m, m^2 ... modulo 2^64 for the multiplier m or its inverse."""
    factor = pow(MULTIPLIER, -1, 1 << 64) if inverse else MULTIPLIER
    out = np.ones(max(1, count), dtype=np.uint64)
    size = 1
    while size < count:
        step = np.uint64(pow(factor, size, 1 << 64))
        take = min(size, count - size)
        out[size : size + take] = out[:take] * step
        size += take
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


class SpanHash:
    """64-bit polynomial hashes of any spans of a byte array, from one running sum."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(BYTE_CODES[data] * powers(len(data))[: len(data)], out=self.sums[1:])
        self.inverse = powers(len(data) + 1, inverse=True)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mix(raw + (ends - starts).astype(np.uint64))


class WordHash(dict):
    """64-bit hashes of words from their bytes; a word is hashed once."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return found

    def of(self, words: list[bytes], most: int = 1_000_000) -> np.ndarray:
        if len(self) > most:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def components(links: DataFrame, label: str) -> DataFrame:
    """``node``, ``root`` (smallest node reachable) of the graph of ``links`` (a, b): large-star and
    small-star steps until nothing changes. Nodes without a link are not in the result. Every step is
    a grouped minimum and a join on the node, so a node with many links is split like any hot key;
    the edges are written after each step and never leave the executors."""

    def least_of(pairs: DataFrame) -> DataFrame:
        # written, so that the join below deals out both sides itself and can split a node's rows
        return write_through(pairs.groupBy("a").agg(F.min("b").alias("m")), f"{label}-least")

    def large(edges: DataFrame) -> DataFrame:
        both = edges.union(edges.select("b", "a"))
        least = least_of(both).select("a", F.least("a", "m").alias("m"))
        return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()

    def small(edges: DataFrame) -> DataFrame:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        joined = down.join(least_of(down), "a")
        return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b"))).filter("a != b").distinct()

    def state(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = write_through(links.select("a", "b").filter("a != b").distinct(), f"{label}-edges")
    before = state(edges)
    while before[0]:
        edges = write_through(small(write_through(large(edges), f"{label}-edges")), f"{label}-edges")
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
