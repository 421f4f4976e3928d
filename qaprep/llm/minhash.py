"""Near duplicates by MinHash, with sequential Bayesian verification.

1. One pass over the texts gives every distinct set of word shingles its MinHash signature. Equal sets are
   one class; everything after it works on classes.
2. Signatures are cut into bands; classes that share a band's values are in one bucket. 32 bands of
   3 values miss a pair at the similarity 0.75 with probability (1 - 0.75^3)^32, below 3e-8.
3. Candidates of a bucket are compared batch by batch of signature values. A pair leaves as soon as the
   posterior probability that its similarity reaches the threshold, given the matches so far and a
   uniform prior, is below ``MISS``.
4. Survivors are verified exactly on their full sets.

A bucket may hold a large share of all classes, so its pairs are never listed. Rounds of leaders come
first: every class of a bucket is compared with a leader, the class that meets most others, which joins
nearly all of a group of near copies by as many pairs as it has members. What is left are the pairs of a bucket whose classes are still in different components. A class there
shares with others at most the shingles that are not its own alone; counting these (one pass over the
sets) rules out exactly, by class and then by pair, whatever cannot reach the threshold, such as copies
with so many edits of their own that they only come near. The rest is compared block against block
(bounded blocks of a bucket, one group each), except for pairs inside the bucket's largest component,
which need no link any more. Blocks bring their full sets and verify what survives, and only the links that join
two components leave them: fewer rows than classes, however many pairs of a large group are near but not
linked. So every candidate pair that could join two components is decided.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaprep.llm.common import WordHash, components, id_of, keyed, mix, slices
from qaprep.session import write_through

WORDS = 5
NUMERATOR, DENOMINATOR = 75, 100
BANDS, BAND_ROWS = 32, 3
#: Signature values; the bands are made of the first ones, the others sharpen the comparison.
VALUES = 192
#: Signature values are compared in batches of this size.
BATCH = 24
#: A pair is given up when the posterior probability of reaching the threshold is below this.
MISS = 1e-7
#: Classes of one block in the last round, and shingles of their sets (on average; a larger set is a block of its own).
BLOCK = 256
BLOCK_SHINGLES = 1 << 20

_PLUS = mix(np.arange(1, VALUES + 1, dtype=np.uint64))
_TIMES = mix(_PLUS) | np.uint64(1)


def shingle_sets(texts: pa.Array, words: int = WORDS, known: WordHash | None = None) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of the word shingles of each text. Words are hashed by their bytes."""
    known = WordHash() if known is None else known
    out = []
    for text in texts.cast(pa.binary()).to_pylist():
        own = known.of((text or b"").lower().split())  # bytes: A-Z only; blank, tab and the line ends
        if len(own) == 0:
            out.append(own)
            continue
        width = min(words, len(own))
        rolled = np.zeros(len(own) - width + 1, dtype=np.uint64)
        for i in range(width):
            rolled = mix(rolled + own[i : i + len(rolled)])
        out.append(np.unique(rolled))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of the hash functions over the set, in pieces of bounded size."""
    least = np.full(len(_PLUS), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 4096):
        part = shingles[at : at + 4096, None]
        np.minimum(least, ((part ^ _PLUS) * _TIMES).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _sign(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"), words, known)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                names=["key", "size", "digest", "sig"],
            )

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), dtype=np.uint32).reshape(batch.num_rows, VALUES)[:, : BANDS * BAND_ROWS].reshape(-1, BANDS, BAND_ROWS).astype(np.uint64)
        bucket = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), sig.shape[:2]).copy()
        for i in range(BAND_ROWS):
            bucket = mix(bucket * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, i])
        node = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), BANDS)
        band = np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(bucket.ravel().view(np.int64), pa.int64()), pa.array(band)], names=["node", "bucket", "band"])


def least_matches(values: int, threshold: float = NUMERATOR / DENOMINATOR, miss: float = MISS) -> int:
    """The fewest matches among ``values`` signature values with which a pair stays. With a uniform prior the
    posterior probability of a similarity of ``threshold`` or more after m matches of n is the chance
    that a binomial draw of n + 1 at ``threshold`` gives m or less."""
    total = 0.0
    for m in range(values + 1):
        total += comb(values + 1, m) * threshold**m * (1 - threshold) ** (values + 1 - m)
        if total >= miss:
            return m
    return values


LEAST = {n: least_matches(n) for n in range(BATCH, VALUES + 1, BATCH)}


def surviving(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of signature rows pass every batch of the sequential test."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), dtype=np.int64)
    for start in range(0, a.shape[1], BATCH):
        stop = min(start + BATCH, a.shape[1])
        matches = matches[: len(alive)] + (a[alive, start:stop] == b[alive, start:stop]).sum(axis=1)
        stays = matches >= LEAST[stop]
        alive, matches = alive[stays], matches[stays]
    return alive


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(len(column), VALUES)


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            stays = surviving(_signatures(batch.column("sig_a")), _signatures(batch.column("sig_b")))
            yield batch.select(["a", "b"]).take(pa.array(stays))


def is_linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets reach the threshold."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return DENOMINATOR * both >= NUMERATOR * (len(x) + len(y) - both)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = [is_linked(*(np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in pair)) for pair in zip(batch.column("set_a"), batch.column("set_b"), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])


def _hash_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for batch in slices(batches, "text"):
            sets = [s.tobytes() for s in shingle_sets(batch.column("text"), words, known)]
            wanted = batch.column("digest").to_pylist()
            own = [i for i, s in enumerate(sets) if hashlib.blake2b(s, digest_size=16).digest() == wanted[i]]
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(own, pa.int32())), pa.array([sets[i] for i in own], pa.binary())], names=["node", "set"])

    return run


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per class and shingle, in bounded batches."""
    for batch in slices(batches, "set", 1 << 20):
        sets = [np.frombuffer(s, dtype=np.int64) for s in batch.column("set").to_pylist()]
        nodes = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), [len(s) for s in sets])
        shingles = np.concatenate(sets)
        for at in range(0, len(nodes), 1 << 17):
            yield pa.RecordBatch.from_arrays([pa.array(nodes[at : at + (1 << 17)]), pa.array(shingles[at : at + (1 << 17)])], names=["node", "shingle"])


def reachable(size_a: np.ndarray, common_a: np.ndarray, size_b: np.ndarray, common_b: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes may be linked when at most ``common`` of their members occur elsewhere."""
    most = np.minimum(common_a, common_b)
    return DENOMINATOR * most >= NUMERATOR * (size_a + size_b - most)


def _candidates(left: pa.Table, right: pa.Table):
    """The right rows that survive against a left row, by the left row's number and the components that both sides have by now.
    Their sizes and shared shingles allow a link; a pair that shares several bands is left to the first of them."""
    ln, rn = (np.asarray(t.column("node")) for t in (left, right))
    ls, rs = _signatures(left.column("sig").combine_chunks()), _signatures(right.column("sig").combine_chunks())
    size, common, own_size, own_common = (np.asarray(t.column(c)) for t in (right, left) for c in ("size", "common"))
    rank, band = np.asarray(right.column("straggler")), left.column("band")[0].as_py()
    banded, mine = (x[:, : BANDS * BAND_ROWS].reshape(-1, BANDS, BAND_ROWS) for x in (rs, ls))

    def of(i: int, lc: np.ndarray, rc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows, and how many values of theirs are equal."""
        # two stragglers meet once, from the smaller one
        others = np.flatnonzero((rc != lc[i]) & (~rank | (rn > ln[i])) & reachable(own_size[i], own_common[i], size, common))
        if band and len(others):
            earlier = (banded[others, :band] == mine[i, :band]).all(axis=2).any(axis=1)
            others = others[~earlier]
        if len(others):
            others = others[surviving(np.broadcast_to(ls[i], (len(others), ls.shape[1])), rs[others])]
        return others, (rs[others] == ls[i]).sum(axis=1)

    return of


def _block_links(table: pa.Table) -> pa.Table:
    """Links between the components of one block pair, verified on the full sets. Once two components are joined, by whatever
    links, their other pairs need no look, so fewer rows leave than components came, however many pairs are only near."""
    left, right = (table.filter(pa.array(np.asarray(table.column("side")) == s)) for s in (0, 1))
    out: list[tuple[int, int]] = []
    if left.num_rows and right.num_rows:
        lc, rc = (np.asarray(t.column("comp")) for t in (left, right))
        names, local = np.unique(np.concatenate([lc, rc]), return_inverse=True)
        now = np.arange(len(names))  # the components by what was joined here
        lc, rc = local[: len(lc)], local[len(lc) :]
        sets = [[np.frombuffer(s, dtype=np.uint64) for s in t.column("set").to_pylist()] for t in (left, right)]
        candidates = _candidates(left, right)
        for i in range(left.num_rows):
            found, equal = candidates(i, now[lc], now[rc])
            for j in found[np.argsort(-equal, kind="stable")]:
                a, b = now[lc[i]], now[rc[j]]
                if a != b and is_linked(sets[0][i], sets[1][j]):
                    out.append((int(names[min(a, b)]), int(names[max(a, b)])))
                    now[now == max(a, b)] = min(a, b)
    return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, digest`` for every row of ``docs``.

    A text with fewer than ``words`` words has one shingle, all its words; a text without words (null, empty,
    white space) has none and is linked with nothing. Repeated rows and other rows that share an id are
    in one component, as it is the id that is linked; each shows the same ``kept``. A null id is an id below
    all others. An empty table gives an empty result."""
    signed = write_through(keyed(docs).mapInArrow(_sign(words), "key bigint, size bigint, digest binary, sig binary"), "signed")
    nodes = write_through(signed.filter("size > 0").groupBy("digest").agg(F.min("key").alias("node"), F.max("sig").alias("sig"), F.max("size").alias("size")), "classes")

    banded = write_through(nodes.select("node", "sig").mapInArrow(_bands, "node bigint, bucket bigint, band int").distinct(), "bands")
    shared = write_through(banded.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1"), "shared")
    buckets = write_through(banded.join(shared, "bucket"), "buckets")
    # how many others a class meets: large for the middle of a group of near copies
    busy = write_through(buckets.groupBy("node").agg(F.sum("size").alias("meets")), "busy")
    sigs = write_through(nodes.join(busy, "node", "left_semi"), "signatures")
    wanted = keyed(docs).join(sigs.select(F.col("node").alias("key"), "digest"), "key")
    sets = write_through(wanted.mapInArrow(_hash_sets(words), "node bigint, set binary"), "sets")
    if not signed.groupBy("key", "digest").count().filter("count > 1 AND digest IS NOT NULL").isEmpty():  # rows that repeat id and text
        sets = write_through(sets.distinct(), "sets")

    def checked(pairs: DataFrame, label: str) -> DataFrame:
        """The pairs that pass, all of them verified on their full sets."""
        with_a = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a")
        both = with_a.join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b")
        decided = both.select("a", "b", "set_a", "set_b").mapInArrow(_verify, "a bigint, b bigint, linked boolean")
        return write_through(decided.filter("linked").select("a", "b").distinct(), label)

    def plausible(pairs: DataFrame) -> DataFrame:
        with_a = pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
        both = with_a.join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b")
        return both.select("a", "b", "sig_a", "sig_b").mapInArrow(_prune, "a bigint, b bigint").distinct()

    def compared(labels: DataFrame, turn: int) -> DataFrame:
        """Links of the classes to the leaders of their buckets, where the labels differ: to those
        that meet most others."""
        members = buckets.join(labels, "node").withColumn("rank", -F.col("meets"))
        leaders = members.groupBy("bucket").agg(F.min(F.struct("rank", "node", "comp")).alias("lead"), F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low != high")
        pairs = members.join(write_through(leaders.select("bucket", "lead"), "leaders"), "bucket").filter("comp != lead.comp")
        if turn == 0:  # one leader for each class does for most
            pairs = pairs.groupBy("node").agg(F.min("lead").alias("lead"))
        return checked(plausible(pairs.select(F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b")).distinct()), "links")

    # labels say who is known to be connected; the first ones follow a class's link to its leader, two steps far
    links = compared(busy.withColumn("comp", F.col("node")), 0)
    step = write_through(links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("comp")), "steps")
    two = step.join(step.select(F.col("node").alias("comp"), F.col("comp").alias("further")), "comp", "left").select("node", F.coalesce("further", "comp").alias("comp"))
    labels = write_through(busy.join(two, "node", "left").select("node", "meets", F.coalesce("comp", "node").alias("comp")), "labels")
    links = links.union(compared(labels, 1))
    labels = write_through(busy.join(components(links, "near"), "node", "left").select("node", F.coalesce("root", "node").alias("comp")), "labels")

    # the classes of buckets that still hold several components, and how many of their shingles occur in another of them
    undecided = buckets.join(labels, "node").groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("all")).filter("low != high AND all > 2")
    open_nodes = write_through(buckets.join(undecided.select("bucket"), "bucket", "left_semi").select("node").distinct(), "open")
    held = sets.join(open_nodes, "node", "left_semi").mapInArrow(_shingle_rows, "node bigint, shingle bigint")
    alone = held.groupBy("shingle").agg(F.min("node").alias("node"), F.count("*").alias("n")).filter("n = 1").groupBy("node").agg(F.count("*").alias("alone"))
    able = sigs.join(open_nodes, "node", "left_semi").join(alone, "node", "left").withColumn("common", F.col("size") - F.coalesce("alone", F.lit(0)))
    able = write_through(able.filter(F.col("common") * DENOMINATOR >= F.col("size") * NUMERATOR).select("node", "size", "common", "sig"), "able")

    def opened() -> DataFrame:
        """Links between the components of the buckets that still hold several, block against block."""
        members = buckets.filter("size > 2").drop("size").join(able.select("node", "size", "common"), "node").join(labels, "node")
        sizes = members.groupBy("bucket", "comp").agg(F.count("*").alias("n"), F.sum("size").alias("shingles")).groupBy("bucket").agg(F.max(F.struct("n", "comp")).alias("top"), F.count("*").alias("comps"), F.sum("n").alias("all"), F.sum("shingles").alias("shingles"))
        sizes = sizes.filter("comps > 1")  # two classes: compared as leader and member
        sizes = sizes.select("bucket", F.col("top.comp").alias("top"), *(F.ceil(F.greatest(n / BLOCK, F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias(name) for n, name in ((F.col("all") - F.col("top.n"), "left_blocks"), (F.col("all"), "right_blocks"))))
        rest = members.join(write_through(sizes, "open"), "bucket").join(able.select("node", "sig"), "node").withColumn("straggler", F.col("comp") != F.col("top")).join(sets, "node")
        slot = F.xxhash64("node", F.lit("block"))
        left = rest.filter("straggler").withColumns({"l": F.pmod(slot, "left_blocks"), "r": F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("right_blocks").cast("bigint") - 1))})
        right = rest.withColumns({"r": F.pmod(slot, "right_blocks"), "l": F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("left_blocks").cast("bigint") - 1))})
        both = left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1))).select("bucket", "band", "l", "r", "side", "node", "comp", "straggler", "size", "common", "sig", "set")
        return both.groupBy("bucket", "l", "r").applyInArrow(_block_links, "a bigint, b bigint").distinct()

    more = write_through(opened(), "links")  # what is left: every pair, verified where it is met

    member_of = write_through(signed.filter("size > 0").select("key", "digest").join(nodes.select("digest", "node"), "digest").select("key", "digest", "node"), "members")
    several = member_of.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low != high")  # one id, several texts
    same_id = several.select(F.col("low").alias("a"), F.col("high").alias("b")).union(member_of.join(write_through(several, "several"), "key").select(F.col("low").alias("a"), F.col("node").alias("b")))
    for end in ("a", "b"):
        same_id = same_id.join(labels.select(F.col("node").alias(end), F.col("comp").alias(f"{end}_comp")), end, "left").withColumn(end, F.coalesce(f"{end}_comp", end)).select("a", "b")
    found = write_through(components(more.union(same_id), "near-all"), "found")
    roots = nodes.select("node").distinct().join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    roots = roots.join(found.select(F.col("node").alias("comp"), "root"), "comp", "left").select("node", F.coalesce("root", "comp").alias("root"))
    linked = member_of.join(write_through(roots, "roots"), "node").select("key", "digest", "root")
    rows = signed.select("key", "size", "digest").join(linked.dropDuplicates(["key", "digest"]), ["key", "digest"], "left").withColumn("root", F.coalesce("root", "key"))
    return rows.select(id_of(F.col("key")).alias("doc_id"), F.col("size").alias("n_shingles"), id_of(F.col("root")).alias("component_id"), (F.col("key") == F.col("root")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` that stay, one document of each component, with all their columns. Rows that
    repeat an id are one document: the one with the longest text stays (a tie: the first by text)."""
    decided = near_duplicates(docs, words)
    kept = decided.filter("kept").groupBy(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("_key")).agg(F.count("*").alias("_copies"))
    kept = write_through(kept, "kept")
    rows = docs.withColumn("_key", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)))).join(kept, "_key")
    if not kept.filter("_copies > 1").isEmpty():
        best = F.max(F.struct(F.length(F.coalesce("text", F.lit(""))), F.coalesce("text", F.lit("")), F.struct(*[F.col(f"`{c}`") for c in docs.columns])))
        rows = rows.groupBy("_key").agg(best.alias("_best")).select("_best.col3.*")
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
