"""Exact duplicates by deterministic block naming.

Every normalised text (A-Z lower-cased) is cut into blocks of a fixed number of bytes. All blocks are
sorted and numbered, equal blocks alike. Then each document is a row of numbers, and adjacent numbers
are named by sorting the pairs, again and again, until one number is left. Names never come from a
hash alone, so two documents have the same last name exactly if their texts are equal.

The sort is a range partitioning by (64-bit hash of the value, document, position), so that equal values
of any number are spread over as many tasks as they need; the bytes decide inside a task, and a table of
the values at the partitions' edges joins the runs that a partition boundary cuts.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaprep.llm.common import id_of, keyed, slices
from qaprep.session import write_through

BLOCK = 1024

_BLOCKS = "key bigint, copy bigint, blocks bigint, pos bigint, sha binary, h bigint, value binary"
_ROWS = pa.schema([("key", pa.int64()), ("copy", pa.int64()), ("blocks", pa.int64()), ("pos", pa.int64()), ("sha", pa.binary()), ("h", pa.int64()), ("value", pa.binary())])


def _cut(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows: list[tuple] = []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                text = text.lower()  # bytes: A-Z only
                sha = hashlib.sha256(text).digest()
                copy = int.from_bytes(sha[:8], "little", signed=True)
                count = max(1, -(-len(text) // block))
                for pos in range(count):
                    value = text[pos * block : (pos + 1) * block]
                    h = int.from_bytes(hashlib.blake2b(value, digest_size=8).digest(), "little", signed=True)
                    rows.append((key, copy, count, pos, None if pos else sha, h, value))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), _ROWS, strict=True)], schema=_ROWS)

    return run


def _number(values: list[str]):
    """Number the runs of equal values in a sorted partition; at its end one row with the values (and
    their numbers) that share the first or the last hash, as only these can go on in a neighbour."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        number, last, first_h, at_h = -1, None, None, None
        first: dict[tuple, int] = {}
        tail: dict[tuple, int] = {}
        schema = pa.schema([("key", pa.int64()), ("copy", pa.int64()), ("blocks", pa.int64()), ("pos", pa.int64()), ("sha", pa.binary()), ("part", pa.int32()), ("number", pa.int64()), ("edge", pa.binary())])
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            columns = [batch.column(c) for c in ["h", *values]]
            changed = None
            for c in columns:
                differs = pc.not_equal(c.slice(1), c.slice(0, n - 1))
                changed = differs if changed is None else pc.or_(changed, differs)
            head = tuple(c[0].as_py() for c in columns)
            starts = pa.concat_arrays([pa.array([head != last]), changed])
            numbers = pc.add(pc.cumulative_sum(starts.cast(pa.int64())), number)
            fresh = pc.indices_nonzero(starts)
            if last is None:
                first_h = head[0]
            # the distinct values of the first and the last hash
            hs = columns[0].take(fresh).to_pylist()
            news = fresh.to_pylist()
            i = 0
            while i < len(news) and hs[i] == first_h:
                first[tuple(c[news[i]].as_py() for c in columns)] = numbers[news[i]].as_py()
                i += 1
            if hs:
                end = hs[-1]
                if end != at_h:
                    tail, at_h = {}, end
                i = len(news) - 1
                while i >= 0 and hs[i] == end:
                    tail[tuple(c[news[i]].as_py() for c in columns)] = numbers[news[i]].as_py()
                    i -= 1
            number, last = numbers[n - 1].as_py(), tuple(c[n - 1].as_py() for c in columns)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "copy", "blocks", "pos", "sha")), pa.repeat(pa.scalar(part, pa.int32()), n), numbers, pa.nulls(n, pa.binary())], schema=schema)
        if last is not None:
            edge = pickle.dumps((number + 1, {**first, **tail}))
            yield pa.RecordBatch.from_pylist([{"key": 0, "copy": 0, "blocks": 0, "pos": 0, "part": part, "number": -1, "edge": edge}], schema=schema)

    return run


def name_values(rows: DataFrame, values: list[str], base: int, label: str) -> tuple[DataFrame, int]:
    """``rows`` (key, copy, blocks, pos, sha, h, values) with ``name`` instead of the values: equal values
    get one integer from ``base`` on, others another. Returns them and the first number not used."""
    dealt = rows.repartitionByRange("h", "key", "copy", "pos").sortWithinPartitions("h", *values, "key", "copy", "pos")
    out = write_through(dealt.mapInArrow(_number(values), "key bigint, copy bigint, blocks bigint, pos bigint, sha binary, part int, number bigint, edge binary"), label)
    edges = sorted((r.part, *pickle.loads(r.edge)) for r in out.filter("edge IS NOT NULL").select("part", "edge").toLocalIterator())  # a row per partition
    offsets, corrected, seen = [], [], {}
    for part, count, values_at_edge in edges:
        offsets.append((part, base))
        for value, number in values_at_edge.items():
            if seen.setdefault(value, base + number) != base + number:
                corrected.append((base + number, seen[value]))
        base += count
    spark = rows.sparkSession
    named = out.filter("edge IS NULL").join(F.broadcast(spark.createDataFrame(offsets, "part int, start bigint")), "part")
    named = named.withColumn("raw", F.col("start") + F.col("number")).join(F.broadcast(spark.createDataFrame(corrected, "raw bigint, right bigint")), "raw", "left")
    return named.select("key", "copy", "blocks", "pos", "sha", F.coalesce("right", "raw").alias("name")), base


def identities(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: key, copy (tells texts under one id apart), sha, identity.
    Equal identities mean equal normalised texts."""
    rows = keyed(docs).mapInArrow(_cut(block), _BLOCKS)
    named, base = name_values(rows, ["value"], 0, "blocks")
    members = named.filter("pos = 0").select("key", "copy", "sha")
    done = named.filter("blocks = 1").select("key", "copy", "name")
    left = named.filter("pos = 0").agg(F.max("blocks")).first()[0] or 1
    while left > 1:
        half = F.shiftright("pos", 1)
        pairs = (
            named.filter("blocks > 1")
            .groupBy("key", "copy", F.shiftright(F.col("blocks") + 1, 1).alias("blocks"), half.alias("pos"))
            .agg(F.max(F.expr("CASE WHEN pos % 2 = 0 THEN name END")).alias("left_name"), F.coalesce(F.max(F.expr("CASE WHEN pos % 2 = 1 THEN name END")), F.lit(-1)).alias("right_name"))
        )
        pairs = pairs.withColumns({"sha": F.lit(None).cast("binary"), "h": F.xxhash64("left_name", "right_name")})
        named, base = name_values(pairs, ["left_name", "right_name"], base, "pairs")
        done = done.union(named.filter("blocks = 1").select("key", "copy", "name"))
        left = (left + 1) // 2
    # a row that repeats id and text has the same (key, copy)
    names = done.groupBy("key", "copy").agg(F.max("name").alias("identity"))
    return write_through(members.join(names, ["key", "copy"]), "identities")


def exact_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256, copy`` for every row of ``docs``.

    Of equal texts the largest ``doc_id`` stays. Null and empty texts are equal to one another. Rows that
    repeat id and text count one by one in ``group_size`` and all show the same ``kept``; a group in
    which every id is null keeps the null id. An empty table gives an empty result."""
    named = identities(docs, block)
    groups = write_through(named.groupBy("identity").agg(F.max("key").alias("keep"), F.count("*").alias("group_size")).filter("group_size > 1"), "groups")
    out = named.join(groups, "identity", "left").withColumns({"keep": F.coalesce("keep", "key"), "group_size": F.coalesce("group_size", F.lit(1)).cast("bigint")})
    return out.select(
        id_of(F.col("key")).alias("doc_id"), id_of(F.col("keep")).alias("keep_id"), "group_size", (F.col("key") == F.col("keep")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), "copy",
    )


def drop_exact_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all their columns."""
    result = exact_duplicates(docs, block).filter("kept").select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("_key"), F.col("text_sha256").alias("_sha"))
    repeated = result.groupBy("_key", "_sha").count()
    lowered = F.sha2(F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").cast("binary"), 256)
    marked = docs.withColumns({"_key": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))), "_sha": lowered})
    kept = marked.join(repeated, ["_key", "_sha"])
    if not repeated.filter("count > 1").isEmpty():  # rows that repeat an id and its text
        kept = kept.dropDuplicates(["_key", "_sha"])
    return kept.select(*[kept[c] for c in docs.columns])
