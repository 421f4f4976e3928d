"""Trie of conversations by their turns, with a z-fast trie per group of conversations.

A node of the trie stands for a sequence of first turns that some conversation begins with. Prefixes are told
apart by signatures: the sum, in four lanes of 32 bits, of a hash of each turn and its place, so that the
signatures of a long conversation are running sums that many tasks can share.

1. Conversations are cut into strings of ``CHUNK`` turns, each with the signature it starts from (its root).
   Equal strings are one. A conversation of any length is so many bounded rows.
2. Roots with more than ``GROUP`` strings are opened one turn at a time: each next turn is a node and the
   root of a smaller group. What is left are groups that fit a task.
3. A task builds a z-fast trie of its groups. Its compacted nodes are hashed at their two-fattest depths (the
   depth on the node's edge that the highest power of two divides). The exit node of a string is found by fat
   binary search, in as many probes as its length has bits. Strings come in growing batches: all of a batch are
   located first, and one is located again only if the batch has changed its exit node since.
4. Every sum over a subtree becomes a sum over members. A node's value is charged to its smallest member, whose
   other charges above the node are taken off again; so no step goes level by level.
5. Edges are expanded to a row per turn at the end.

Broadcast hints are not used; group minima and counts combine before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qaprep.llm.common import NO_ID, id_of, session
from qaprep.operators.indexing import group_positions
from qaprep.session import write_through

CHUNK = 64
GROUP = 2048
FIRST_BATCH = 64
#: Ids are joined in pieces of about this many before they are hashed one piece after the other.
IDS_PER_PIECE = 8192
ROOT = bytes(16)
_LANE = (1 << 32) - 1


def two_fattest(low: int, high: int) -> int:
    """The number above ``low`` and up to ``high`` that the highest power of two divides."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class ZFastTrie:
    """Compacted trie of strings under one root. A string is the signatures of its prefixes, 16 bytes each."""

    def __init__(self, root: bytes):
        self.root = root
        self.strings: list[bytes] = []
        # of each compacted node: depth of its parent and its own, parent, a string through it, batch of its last change
        self.start, self.extent, self.parent, self.through, self.changed = [0], [0], [-1], [-1], [-1]
        self.handles: dict[bytes, int] = {}
        self.first: dict[bytes, int] = {}  # signature after an edge's first turn
        self.ends: list[int] = []
        self.batch = 0

    def prefix(self, string: bytes, depth: int) -> bytes:
        return string[16 * depth - 16 : 16 * depth] if depth else self.root

    def name(self, node: int) -> bytes:
        """The signature of the node's extent."""
        return self.prefix(self.strings[self.through[node]], self.extent[node]) if node else self.root

    def locate(self, string: bytes) -> tuple[int, int]:
        """The exit node of a string and how many turns it shares with it."""
        node, low, high = 0, 0, len(string) // 16
        while low < high:
            depth = two_fattest(low, high)
            found = self.handles.get(string[16 * depth - 16 : 16 * depth])
            if found is None:
                high = depth - 1
            else:
                node, low = found, self.extent[found]
        size = len(string) // 16
        if size > self.extent[node] and (node == 0 or self.name(node) == self.prefix(string, self.extent[node])):
            node = self.first.get(self.prefix(string, self.extent[node] + 1), node)
        # the shared part of the edge: equal signatures up to some depth, others after it
        own = self.strings[self.through[node]] if node else b""
        low, high = self.start[node], min(self.extent[node], size)
        while low < high:
            middle = (low + high + 1) // 2
            if own[16 * middle - 16 : 16 * middle] == string[16 * middle - 16 : 16 * middle]:
                low = middle
            else:
                high = middle - 1
        return node, low

    def _handle(self, node: int) -> None:
        depth = two_fattest(self.start[node], self.extent[node])
        self.handles[self.prefix(self.strings[self.through[node]], depth)] = node
        self.first[self.prefix(self.strings[self.through[node]], self.start[node] + 1)] = node

    def _add(self, start: int, extent: int, parent: int, string: int) -> int:
        for table, value in ((self.start, start), (self.extent, extent), (self.parent, parent), (self.through, string), (self.changed, self.batch)):
            table.append(value)
        self._handle(len(self.start) - 1)
        return len(self.start) - 1

    def _insert(self, number: int, node: int, shared: int) -> int:
        """The node at which the string ends, made if need be."""
        size = len(self.strings[number]) // 16
        if shared < self.extent[node]:  # the edge is cut
            del self.handles[self.prefix(self.strings[self.through[node]], two_fattest(self.start[node], self.extent[node]))]
            upper = self._add(self.start[node], shared, self.parent[node], self.through[node])
            self.start[node], self.parent[node], self.changed[node] = shared, upper, self.batch
            self._handle(node)
            node = upper
        self.changed[node] = self.batch
        return node if shared == size else self._add(shared, size, node, number)

    def insert(self, batch: list[bytes]) -> None:
        exits = [self.locate(s) for s in batch]
        for string, (node, shared) in zip(batch, exits, strict=True):
            if self.changed[node] == self.batch:
                node, shared = self.locate(string)
            self.strings.append(string)
            self.ends.append(self._insert(len(self.strings) - 1, node, shared))
        self.batch += 1

    def fill(self, strings: list[bytes]) -> None:
        at, size = 0, FIRST_BATCH
        while at < len(strings):
            self.insert(strings[at : at + size])
            at, size = at + size, 2 * size


_NODES = "id binary, p bigint, e bigint, parent binary, rep bigint, n bigint, chars array<bigint>"
_BUILT = f"sid binary, {_NODES}"
_ARROW = pa.schema([("sid", pa.binary()), ("id", pa.binary()), ("p", pa.int64()), ("e", pa.int64()), ("parent", pa.binary()), ("rep", pa.int64()), ("n", pa.int64()), ("chars", pa.list_(pa.int64()))])


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings sorted by root: the compacted nodes of each root (``sid`` null), and the nodes on each string's path."""

    def trie_of(rows: list[dict]) -> list[tuple]:
        base, root = rows[0]["depth"], rows[0]["root"]
        trie = ZFastTrie(root)
        trie.fill([r["sigs"] for r in rows])
        count = len(trie.start)
        reps, sums = [None] * count, [0] * count
        for end, r in zip(trie.ends, rows, strict=True):
            sums[end] += r["n"]
            reps[end] = r["rep"] if reps[end] is None else min(reps[end], r["rep"])
        names, out = [trie.name(i) for i in range(count)], []
        for node in sorted(range(1, count), key=lambda i: -trie.extent[i]):
            up = trie.parent[node]
            if up:
                sums[up] += sums[node]
                reps[up] = reps[node] if reps[up] is None else min(reps[up], reps[node])
            a, b = trie.start[node], trie.extent[node]
            out.append((None, names[node], base + a, base + b, names[up], reps[node], sums[node], rows[trie.through[node]]["chars"][a:b]))
        for end, r in zip(trie.ends, rows, strict=True):
            while end:
                out.append((r["sid"], names[end], None, None, None, None, None, None))
                end = trie.parent[end]
        return out

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)

    group: list[dict] = []
    out: list[tuple] = []
    for batch in batches:
        for row in batch.to_pylist():
            if group and row["root"] != group[0]["root"]:
                out += trie_of(group)
                group = []
                if len(out) > 10_000:
                    yield packed(out)
                    out = []
            group.append(row)
    if group:
        out += trie_of(group)
    if out:
        yield packed(out)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running sums of the turns of each string, from the sums before it, as signatures."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        turns = batch.column("turns")
        sizes = np.diff(turns.offsets.to_numpy())
        flat = turns.flatten()
        lanes = np.stack([flat.field(f"l{i}").to_numpy() for i in range(4)], axis=1).astype(np.uint64)
        before = np.stack([batch.column(f"b{i}").to_numpy() for i in range(4)], axis=1).astype(np.uint64)
        starts = np.concatenate(([0], np.cumsum(sizes)))
        sums = np.concatenate((np.zeros((1, 4), np.uint64), np.cumsum(lanes, axis=0)))
        running = ((sums[1:] - np.repeat(sums[starts[:-1]], sizes, axis=0) + np.repeat(before, sizes, axis=0)) & np.uint64(_LANE)).astype("<u4")
        raw, first = running.tobytes(), (before & np.uint64(_LANE)).astype("<u4").tobytes()
        sigs = [raw[16 * a : 16 * b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
        chars = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), flat.field("chars"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("j"), pa.array([first[16 * i : 16 * i + 16] for i in range(n)], pa.binary()), pa.array(sigs, pa.binary()), pa.array([s[-16:] for s in sigs], pa.binary()), chars],
            names=["conv", "j", "root", "sigs", "sid", "chars"],
        )


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids sorted by end and value, joined in pieces: end, first id, text."""
    end, ids, out = None, [], []

    def close() -> None:
        if ids:
            out.append((end, ids[0], ",".join("" if i == NO_ID else str(i) for i in ids)))

    for batch in batches:
        for e, c in zip(batch.column("sid").to_pylist(), batch.column("conv").to_pylist(), strict=True):
            if e != end or len(ids) >= IDS_PER_PIECE:
                close()
                end, ids = e, []
            ids.append(c)
        if len(out) > 4000:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["sid", "first", "ids"])
            out = []
    close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["sid", "first", "ids"])


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by end and first id: the SHA-256 of all pieces of an end, one piece at a time."""
    end, state, out = None, None, []
    for batch in batches:
        for e, ids in zip(batch.column("sid").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if e != end:
                if state is not None:
                    out.append((end, state.hexdigest()))
                end, state = e, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if state is not None:
        out.append((end, state.hexdigest()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([e for e, _ in out], pa.binary()), pa.array([d for _, d in out])], names=["id", "ends_sha256"])


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv, pos`` (from 0), ``role, text`` of every turn, by turn number (null first), then role and text. A null
    role or text is empty, a null ``conv_id`` an id of its own below all others (``NO_ID``)."""
    turns = conversations.select(
        F.coalesce(F.col("conv_id").cast("bigint"), F.lit(NO_ID)).alias("conv"), F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("place"),
    )
    numbered = group_positions(turns, ["conv"], ["turn", "role", "text", "place"], "pos")
    return write_through(numbered.select("conv", "pos", "role", "text"), "turns")


def prefix_trie(turns: DataFrame, convs: DataFrame, chunk: int = CHUNK, group: int = GROUP) -> DataFrame:
    """The nodes of the trie of conversations: ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256``.

    ``turns``: conv, depth (1, 2, ... in each conversation), role, text; ``convs``: every conv once, with ``size``, its
    number of turns, which may be 0. The root has depth 0 and no parent; it is there if there is any conversation.
    A node's turn is that of ``conv_id`` at ``depth`` (``node_turns``). ``saved_tokens`` counts code points. The null id
    (``NO_ID``) is null again in the result and an empty text among the joined ids. Equal conversations share all nodes."""
    spark = session(turns.sparkSession)
    if convs.isEmpty():
        return spark.createDataFrame([], "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string")
    code = F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text"))
    a, b = F.xxhash64("depth", code), F.xxhash64(F.lit("second"), code, "depth")
    lanes = [a.bitwiseAND(F.lit(_LANE)), F.shiftrightunsigned(a, 32), b.bitwiseAND(F.lit(_LANE)), F.shiftrightunsigned(b, 32)]
    coded = turns.select("conv", "depth", ((F.col("depth") - 1) / chunk).cast("bigint").alias("j"), *[x.alias(f"l{i}") for i, x in enumerate(lanes)], F.length("text").cast("bigint").alias("chars"))
    chunks = coded.groupBy("conv", "j").agg(F.sort_array(F.collect_list(F.struct("depth", "l0", "l1", "l2", "l3", "chars"))).alias("turns"), *[F.sum(f"l{i}").alias(f"s{i}") for i in range(4)])
    chunks = write_through(chunks, "chunks")
    # a row per chunk of the conversations of several chunks
    before = Window.partitionBy("conv").orderBy("j").rowsBetween(Window.unboundedPreceding, -1)
    long = chunks.select("conv", "j", *[f"s{i}" for i in range(4)]).join(convs.filter(F.col("size") > chunk).select("conv"), "conv", "left_semi")
    sums = long.select("conv", "j", *[F.sum(F.col(f"s{i}").bitwiseAND(F.lit(_LANE))).over(before).alias(f"b{i}") for i in range(4)])
    signed = chunks.join(sums.filter("j > 0"), ["conv", "j"], "left").select("conv", "j", "turns", *[F.coalesce(f"b{i}", F.lit(0)).cast("bigint").alias(f"b{i}") for i in range(4)])
    signed = write_through(signed.mapInArrow(_sign, "conv bigint, j bigint, root binary, sigs binary, sid binary, chars array<bigint>"), "signed")

    # equal strings are one
    counted = signed.groupBy("sid").agg(F.min("conv").alias("conv"), F.count("*").alias("n"))
    strings = signed.join(counted, ["sid", "conv"]).select("sid", "root", (F.col("j") * chunk).alias("depth"), "sigs", "chars", F.col("conv").alias("rep"), "n")
    strings = write_through(strings, "strings")
    upper, paths, waiting = [], [], strings
    while True:
        sizes = waiting.groupBy("root").agg(F.count("*").alias("_strings")).filter(F.col("_strings") > group)
        hot = write_through(sizes.select("root"), "hot")
        if hot.isEmpty():
            break
        opened = write_through(waiting.join(hot, "root").withColumn("child", F.substring("sigs", 1, 16)), "opened")
        upper.append(
            opened.groupBy("root", "child", "depth", F.col("chars")[0].alias("first")).agg(F.min("rep").alias("rep"), F.sum("n").alias("n"))
            .select(F.col("child").alias("id"), F.col("depth").alias("p"), (F.col("depth") + 1).alias("e"), F.col("root").alias("parent"), "rep", "n", F.array("first").alias("chars"))
        )
        paths.append(opened.select("sid", F.col("child").alias("id")))
        rest = opened.filter(F.octet_length("sigs") > 16).select(
            "sid", F.col("child").alias("root"), (F.col("depth") + 1).alias("depth"), F.expr("substring(sigs, 17)").alias("sigs"), F.expr("slice(chars, 2, size(chars) - 1)").alias("chars"), "rep", "n"
        )
        waiting = write_through(waiting.join(hot, "root", "left_anti").unionByName(rest), "waiting")
    dealt = waiting.repartition("root").sortWithinPartitions("root")
    built = write_through(dealt.mapInArrow(_build, _BUILT), "built")
    nodes, path = built.filter("sid IS NULL").drop("sid"), built.filter("sid IS NOT NULL").select("sid", "id")
    for more in upper:
        nodes = nodes.unionByName(more)
    for more in paths:
        path = path.unionByName(more)

    kids = nodes.groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    value = (F.col("n") - 1) * F.expr("reduce(chars, 0L, (a, c) -> a + c)")
    nodes = write_through(nodes.join(kids, "id", "left").withColumns({"n_children": F.coalesce("n_children", F.lit(0)).cast("bigint"), "value": value}), "nodes")
    charged = write_through(nodes.groupBy(F.col("rep").alias("conv")).agg(F.sum("value").alias("own"), F.count_if(F.col("n_children") == 0).alias("leaves")), "charged")
    of_string = signed.select("conv", "sid").join(charged, "conv").groupBy("sid").agg(F.sum("own").alias("own"), F.sum("leaves").alias("leaves"))
    of_node = path.join(of_string, "sid").groupBy("id").agg(F.sum("own").alias("own"), F.sum("leaves").alias("n_leaves"))
    above = Window.partitionBy("rep").orderBy("e").rowsBetween(Window.unboundedPreceding, -1)  # a row per edge that a conversation is the smallest on
    sized = nodes.withColumn("above", F.coalesce(F.sum("value").over(above), F.lit(0)).cast("bigint")).join(of_node, "id")

    least, total = convs.agg(F.min("conv"), F.count("*")).first()
    names = nodes.select(F.col("id").alias("parent"), F.col("rep").alias("up"))
    sized = sized.join(names, "parent", "left").withColumn("up", F.coalesce("up", F.lit(least)))
    # ids of the conversations that end at a node
    ends = signed.join(convs.select("conv", F.floor((F.col("size") - 1) / chunk).cast("bigint").alias("j")), ["conv", "j"]).select("sid", "conv")
    ends = ends.union(convs.filter("size = 0").select(F.lit(ROOT).alias("sid"), "conv"))
    pieces = write_through(ends.repartitionByRange("sid", "conv").sortWithinPartitions("sid", "conv").mapInArrow(_joined_ids, "sid binary, first bigint, ids string"), "ends")
    digests = write_through(pieces.repartition("sid").sortWithinPartitions("sid", "first").mapInArrow(_hashed_ids, "id binary, ends_sha256 string"), "digests")

    step = F.expr(
        "transform(sequence(1, size(chars)), i -> struct(p + i AS depth, IF(i = 1, up, rep) AS parent, IF(i = size(chars), n_children, 1L) AS n_children,"
        " own - above - (n - 1) * reduce(slice(chars, 1, i - 1), 0L, (a, c) -> a + c) AS saved, IF(i = size(chars), ends_sha256, NULL) AS ends))"
    )
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    rows = sized.join(digests, "id", "left").select("rep", "n", "n_leaves", F.explode(step).alias("s"))
    below = rows.select(
        id_of(F.col("rep")).alias("conv_id"), "s.depth", id_of(F.col("s.parent")).alias("parent_conv_id"), F.col("n").alias("n_convs"), "s.n_children", "n_leaves",
        F.col("s.saved").alias("saved_tokens"), F.coalesce("s.ends", nothing).alias("ends_sha256"),
    )
    top = charged.agg(F.coalesce(F.sum("own"), F.lit(0)).cast("bigint").alias("saved_tokens"), F.greatest(F.coalesce(F.sum("leaves"), F.lit(0)), F.lit(1)).cast("bigint").alias("n_leaves"))
    children = nodes.filter(F.col("parent") == F.lit(ROOT)).agg(F.count("*").alias("n_children"))
    end = digests.filter(F.col("id") == F.lit(ROOT)).agg(F.max("ends_sha256").alias("ends"))
    one = F.lit(1)
    root = top.withColumn("k", one).join(children.withColumn("k", one), "k").join(end.withColumn("k", one), "k")  # a row each
    root = root.select(
        id_of(F.lit(least)).cast("bigint").alias("conv_id"), F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"), F.lit(total).cast("bigint").alias("n_convs"),
        "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", nothing).alias("ends_sha256"),
    )
    return below.unionByName(root)


def node_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """``nodes`` with the role and the text of their last turn (null for the root)."""
    keys = turns.select(F.col("conv").alias("_conv"), "depth", "role", "text")
    return nodes.withColumn("_conv", F.coalesce("conv_id", F.lit(NO_ID))).join(keys, ["_conv", "depth"], "left").drop("_conv")
