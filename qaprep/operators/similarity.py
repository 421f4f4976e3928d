"""Fingerprints, exact similarity joins and diverse picks.

A fingerprint is a set of bits below 2048, kept as words of 64 bits. Candidates come from an equality
join on composite keys (a prefix filter, Bayardo et al. 2007, with the positional bound of Xiao et al. 2008):

* Bits that always occur together (the pieces of one chemical unit) are one key that weighs as much as they
  are. Keys are ordered by how few rows they have for their weight, so a few keys make up a prefix.
* The larger row of a pair brings the prefix for its own size, the smaller one only the shorter prefix that
  suffices against rows of its size or more; and both bring a band of sizes, so that they meet only if
  their sizes agree.

Every candidate is verified by bit counts, inside the join condition or, for all pairs of one table, block by block
in Arrow batches; only verified rows leave the join.
Equal fingerprints are collapsed first, so a third of all rows being copies of one another costs one row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaprep.session import spread, write_through

BITS = 2048
# Thresholds of the diverse-subset recipe.
PICK_DISTANCE = 0.6
SIMILAR_LOW, SIMILAR_HIGH = 0.45, 0.65
SIZE_LOW, SIZE_HIGH = 0.83, 1.17

#: Sizes of a band differ by less than this factor.
BAND = 1.2
#: Rows whose runs are hashed at once.
FINGERPRINT_ROWS = 500
FIRST_CHUNK = 2048
CHUNK_GROWTH = 16
HOT_ROWS = 50_000
#: Edges of a block that one task scans.
BLOCK_EDGES = 1_000_000
BROADCAST_ROWS = 200_000  # prefix rows, at most about 300 bytes each
#: Prefix rows of one side that a task compares with as many of the other side.
BLOCK_ROWS = 16_384
#: Rows of a tile, by side, and pairs sent on at once.
TILE = (512, 1024)
PAIRS_AT_ONCE = 1 << 17


def _run_bits(text: str, lengths: np.ndarray, gram: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and bit of every set bit, in order, of rows that lie in ``text`` one after the other. A run is hashed once."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(row))  # characters from this one to the row's end
    found = np.zeros((len(lengths), bits), dtype=bool)
    number = np.zeros(len(codes), dtype=np.int64)  # of the run one shorter that begins here
    for size in range(1, gram + 1):
        at = np.flatnonzero(left >= size)
        _, first, inverse = np.unique(number[at] << 21 | codes[at + size - 1], return_index=True, return_inverse=True)
        number[at] = inverse
        digests = [hashlib.md5(text[p : p + size].encode(), usedforsecurity=False).digest() for p in at[first].tolist()]
        position = np.array([int.from_bytes(d[:4], "big") % bits for d in digests], dtype=np.int64)
        found[row[at], position[inverse]] = True
    return np.nonzero(found)


def fingerprint(text: Column, gram: int = 3, bits: int = BITS) -> Column:
    """Sorted set bits: one per character run of length 1 to ``gram``, hashed by md5. A null text has none, not even an empty set."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def run(texts: pa.Array) -> pa.Array:
        filled = pc.fill_null(texts, "")
        rows, own = [], []
        for start in range(0, len(filled), FINGERPRINT_ROWS):
            part = filled.slice(start, FINGERPRINT_ROWS).to_pylist()
            row, bit = _run_bits("".join(part), np.array([len(t) for t in part], dtype=np.int64), gram, bits)
            rows.append(row + start)
            own.append(bit)
        counts = np.bincount(np.concatenate(rows), minlength=len(texts)) if rows else np.zeros(0, np.int64)
        offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
        values = pa.array(np.concatenate(own).astype(np.int32) if own else [], pa.int32())
        return pa.ListArray.from_arrays(offsets, values, mask=pc.is_null(texts))

    return run(text)


def tanimoto(a: Column, b: Column) -> Column:
    """Shared bits over all bits; two empty sets have similarity 0."""
    both = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - both
    return F.coalesce(F.try_divide(both, total), F.lit(0.0))


def _shared(words: Sequence[str], a: str, b: str) -> str:
    return " + ".join(f"bit_count({a}.{w} & {b}.{w})" for w in words)


def _needed(threshold: float, sizes: str) -> str:
    """Fewest shared bits two rows of these sizes together can have and still reach the threshold."""
    return f"ceil({threshold / (1.0 + threshold)!r}D * ({sizes}) - 1e-9D)"


def bit_ranks(df: DataFrame, bits: str) -> tuple[dict[int, int], set[int]]:
    """The number of every occurring bit, and the numbers at which a class of bits begins.

    A class holds bits that exactly the same rows have, told by their count and 128 bits of summed row hashes. Its
    bits get numbers in a row; classes are ordered by rows over bits. At most 2048 rows reach the driver."""
    low = F.lit((1 << 32) - 1)
    hashes = [F.xxhash64("_row"), F.xxhash64("_row", F.lit("again"))]
    lanes = [x for h in hashes for x in (h.bitwiseAND(low), F.shiftrightunsigned(h, 32))]
    rows = df.select(F.explode(bits).alias("bit"), F.xxhash64(bits).alias("_row"))
    sums = [F.sum(x).alias(f"s{i}") for i, x in enumerate(lanes)]
    classes: dict[tuple, list[int]] = {}
    for row in rows.groupBy("bit").agg(F.count("*").alias("n"), *sums).collect():
        classes.setdefault((row.n, row.s0, row.s1, row.s2, row.s3), []).append(row.bit)
    ordered = sorted((key[0] / len(members), sorted(members)) for key, members in classes.items())
    ranks: dict[int, int] = {}
    heads: set[int] = set()
    for _, members in ordered:
        heads.add(len(ranks))
        for bit in members:
            ranks[bit] = len(ranks)
    return ranks, heads


def word_columns(prints: DataFrame) -> list[str]:
    return [c for c in prints.columns if c.startswith("word_")]


def number_bits(df: DataFrame, numbering: tuple[dict[int, int], set[int]]) -> DataFrame:
    """Renumber ``bits``, count them and pack them into 64-bit words: as many words as there are bits in
    use. ``keys``: (bit, bits from it on) for the first bit of each class."""
    ranks, heads = numbering
    table = F.expr("array(" + ", ".join(str(ranks.get(bit, 0)) for bit in range(BITS)) + ")")
    ranked = df.withColumn("bits", F.array_sort(F.transform("bits", lambda b: F.get(table, b))))
    one = F.lit(1).cast("bigint")

    def word(number: int) -> Column:
        members = F.filter("bits", lambda b: F.shiftright(b, 6) == number)
        add = lambda acc, b: acc.bitwiseOR(F.call_function("shiftleft", one, b % 64))
        return F.aggregate(members, F.lit(0).cast("bigint"), add).alias(f"word_{number}")

    n_words = max(1, math.ceil(len(ranks) / 64))
    words = [word(w) for w in range(n_words)]
    head = F.expr("array(" + ", ".join("true" if rank in heads else "false" for rank in range(max(1, len(ranks)))) + ")")
    placed = F.transform("bits", lambda b, at: F.struct(b.alias("bit"), (F.size("bits") - at).alias("left")))
    keys = F.filter(placed, lambda k: F.get(head, k["bit"]))
    return write_through(ranked.select("*", F.size("bits").alias("n_bits"), keys.alias("keys"), *words), "prints")


def distinct_prints(df: DataFrame, key: str, bits: str, also: Sequence[str] = ()) -> tuple[DataFrame, tuple[dict[int, int], set[int]]]:
    """One numbered row per distinct (fingerprint, *also): lowest key as ``id``, number of rows; and
    the numbering of the bits. Rows without bits are left out: they resemble nothing."""
    filled = df.filter(F.size(bits) > 0).groupBy(F.col(bits).alias("bits"), *also)
    unique = write_through(filled.agg(F.min(key).alias("id"), F.count("*").alias("n_rows")), "unique")
    numbering = bit_ranks(unique, "bits")
    return number_bits(unique, numbering), numbering


def _band(size: Column) -> Column:
    return F.floor(F.log(size.cast("double")) / F.lit(math.log(BAND)) + F.lit(1e-9)).cast("int")


def _prefix(prints: DataFrame, threshold: float, *keep: str, larger: bool) -> DataFrame:
    """One row per prefix key and band of sizes. ``left`` is the number of bits from the key on, which
    bounds what two rows can share.

    Of two rows that reach the threshold, the ``larger`` one (or either of two equal ones) shares at least
    threshold times its bits, the other one at least 2 t / (1 + t) times its own: with fewer bits left than
    that, a key can't be the first common one. The smaller one is placed in the bands of all rows it can match."""
    share = threshold if larger else 2.0 * threshold / (1.0 + threshold)
    least = F.ceil(F.col("n_bits") * F.lit(share) - F.lit(1e-9))
    band = _band(F.col("n_bits"))
    if not larger:
        band = F.explode(F.sequence(band, _band(F.col("n_bits") / F.lit(threshold) + F.lit(1e-6))))
    cut = prints.select("id", "n_bits", *word_columns(prints), *keep, F.explode(F.filter("keys", lambda k: k["left"] >= least)).alias("_key"))
    return cut.select("*", F.col("_key.bit").alias("bit"), F.col("_key.left").alias("left"), band.alias("band")).drop("_key")


def _similar_condition(threshold: float, words: Sequence[str]) -> str:
    """Enough bits are left from the common bit on, the sizes agree, and enough bits are shared. A
    similar pair passes at the first bit it has in common. The cheap tests come first; the words are
    compared for what is left."""
    needed = _needed(threshold, "a.n_bits + b.n_bits")
    return (
        f"least(a.left, b.left) >= {needed} "
        f"AND a.n_bits >= {threshold!r}D * b.n_bits - 1e-9D AND b.n_bits >= {threshold!r}D * a.n_bits - 1e-9D "
        f"AND {_shared(words, 'a', 'b')} >= {needed}"
    )


def _meet(big: DataFrame, small: DataFrame, condition: str, how: str = "inner", also: str = "") -> DataFrame:
    """Join prefix rows ``a`` (big) and ``b`` (small) on bit and band.

    A small side of checked size goes to every task and the big side is not moved. Beyond that both
    are shuffled by bit; the rows of a bit that very many rows have are then cut into slices and meet
    a copy of the other side's rows each, so no task gets a whole hot bit. The counts, one per hot
    bit, are at most 2048.
    """
    on = f"a.bit = b.bit AND a.band = b.band AND {also}{condition}"
    if small.count() <= BROADCAST_ROWS:
        return big.alias("a").join(F.broadcast(small).alias("b"), F.expr(on), how)
    counts = big.groupBy("bit").agg(F.count("*").alias("n")).filter(F.col("n") > HOT_ROWS).collect()
    slices = F.lit(1)
    if counts:
        pairs = [F.lit(x) for row in counts for x in (row["bit"], math.ceil(row["n"] / HOT_ROWS))]
        slices = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("bit")), F.lit(1))
    a = big.withColumn("slice", F.pmod(F.xxhash64("id"), slices))
    b = small.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), slices.cast("bigint") - 1)))
    return a.alias("a").join(b.hint("merge").alias("b"), F.expr(f"a.slice = b.slice AND {on}"), how)


def _block_pairs(threshold: float, words: Sequence[str], keep: Sequence[str]):
    """The similar pairs of a block of larger rows (``side`` 0) and one of smaller rows (1) that meet at one key.

    Common bits are counted for whole tiles by a matrix product over the bits from the key on that both blocks use, less
    the share that is needed (exact in 32 bits up to the tolerance). Rows are in order of size and of bits left, so that tiles whose
    sizes or bounds disagree are not compared. What may reach the threshold is tested again on whole numbers, and for a common
    bit ahead of the key, at which the pair has been found already."""
    share, near = threshold / (1.0 + threshold), -0.01
    columns = ["id", "n_bits", *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).sort_by([("side", "ascending"), ("n_bits", "ascending"), ("left", "ascending")]).combine_chunks()
        bit, cut = table.column("bit")[0].as_py(), int(pc.sum(pc.equal(table.column("side"), 0)).as_py())
        if cut in (0, len(table)):
            return
        number = table.column("n_bits").to_numpy().astype(np.int64)
        slack = table.column("left").to_numpy() - share * number
        rank = pc.rank(table.column("id"), tiebreaker="dense").to_numpy().astype(np.int64)
        named = table.column("id").is_valid().to_numpy()
        packed = np.column_stack([table.column(w).to_numpy() for w in words])
        ahead = np.array([((1 << min(64, max(0, bit - 64 * w))) - 1) for w in range(len(words))], np.uint64).view(np.int64)
        ahead_in = np.flatnonzero(ahead)
        before = np.ascontiguousarray((packed & ahead)[:, ahead_in].T)
        there = np.unpackbits(packed.view(np.uint8), axis=1, bitorder="little")[:, bit:]
        used = np.flatnonzero(there[:cut].any(axis=0) & there[cut:].any(axis=0))
        own = (share * number).astype(np.float32)[:, None]
        one = np.ones_like(own)
        a = np.hstack([there[:cut, used].astype(np.float32), -own[:cut], one[:cut]])
        b = np.ascontiguousarray(np.hstack([there[cut:, used].astype(np.float32), one[cut:], -own[cut:]]).T)
        del there
        found, held = [], 0

        def sent() -> pa.RecordBatch:
            at = [np.concatenate(x) for x in zip(*found, strict=True)]
            values = {f"{c}_{side}": table.column(c).take(pa.array(at[side])).combine_chunks() for c in columns for side in (0, 1)}
            return pa.RecordBatch.from_pydict({"shared": pa.array(at[2], pa.int32()), **values})

        for i in range(0, cut, TILE[0]):
            i_end = min(i + TILE[0], cut)
            i_slack = slack[i:i_end].max()
            for j in range(cut, len(table), TILE[1]):
                j_end = min(j + TILE[1], len(table))
                if number[j] > number[i_end - 1] or number[j_end - 1] < threshold * number[i] - 1e-9:
                    continue
                if i_slack < share * number[j] + near or slack[j:j_end].max() < share * number[i] + near:
                    continue
                over = a[i:i_end] @ b[:, j - cut : j_end - cut]
                hit = np.flatnonzero(over.ravel() >= near)
                if not len(hit):
                    continue
                x, y = np.divmod(hit, j_end - j)
                x, y = x + i, y + j
                n_x, n_y = number[x], number[y]
                shared = np.rint(over.ravel()[hit] + share * (n_x + n_y)).astype(np.int64)
                right = (shared >= np.ceil(share * (n_x + n_y) - 1e-9)) & (n_y >= threshold * n_x - 1e-9)
                right &= (n_x > n_y) | ((n_x == n_y) & (rank[x] > rank[y]) & named[x] & named[y])
                for word in before:
                    right &= (word[x] & word[y]) == 0
                if right.any():
                    found.append((x[right], y[right], shared[right]))
                    held += len(found[-1][0])
                    if held > PAIRS_AT_ONCE:
                        yield sent()
                        found, held = [], 0
        if held:
            yield sent()

    return run


def similar_pairs(prints: DataFrame, threshold: float, *keep: str) -> DataFrame:
    """(id_a < id_b, shared, n_bits_a, n_bits_b) for distinct fingerprints, and both rows' columns ``keep``. A pair
    meets at each prefix key it shares and is kept at the first one, so it comes once.

    The rows of a key and band are dealt to blocks of about ``BLOCK_ROWS``; every block of larger rows meets every
    block of smaller ones, in a task of its own. So no task has more than two blocks, however many rows share a key."""
    spark, words = prints.sparkSession, word_columns(prints)
    rows = spread(prints)
    sides = _prefix(rows, threshold, *keep, larger=True).withColumn("side", F.lit(0)).unionByName(_prefix(rows, threshold, *keep, larger=False).withColumn("side", F.lit(1)))
    blocks = [F.ceil(F.count_if(F.col("side") == side) / BLOCK_ROWS).alias(f"blocks_{side}") for side in (0, 1)]
    keys = write_through(sides.groupBy("bit", "band").agg(*blocks), "blocks").filter("blocks_0 > 0 AND blocks_1 > 0")
    dealt = sides.join(F.broadcast(keys), ["bit", "band"])  # at most 2048 bits times some forty bands
    larger = F.col("side") == 0
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("id", *words), F.when(larger, F.col("blocks_0")).otherwise(F.col("blocks_1"))))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.when(larger, F.col("blocks_1")).otherwise(F.col("blocks_0")) - 1)))
    dealt = dealt.withColumns({"block_0": F.when(larger, F.col("own")).otherwise(F.col("other")), "block_1": F.when(larger, F.col("other")).otherwise(F.col("own"))})
    place = ["bit", "band", "block_0", "block_1"]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)  # by number: the work of two blocks is not in their bytes
    kinds = {c: prints.schema[c].dataType.simpleString() for c in ("id", "n_bits", *keep)}
    schema = ", ".join(["shared int", *(f"`{c}_{side}` {kind}" for c, kind in kinds.items() for side in (0, 1))])
    met = dealt.select(*place, "side", "id", "n_bits", "left", *words, *keep).repartition(tasks, *place)
    met = met.groupBy(*place).applyInArrow(_block_pairs(threshold, words, keep), schema)
    first = F.col("id_0") < F.col("id_1")
    ends = lambda c: (F.when(first, F.col(f"{c}_{x}")).otherwise(F.col(f"{c}_{y}")).alias(f"{c}_{name}") for name, x, y in (("a", 0, 1), ("b", 1, 0)))
    return met.select(
        F.least("id_0", "id_1").alias("id_a"),
        F.greatest("id_0", "id_1").alias("id_b"),
        "shared",
        *(column for c in ("n_bits", *keep) for column in ends(c)),
    )


def similarity_join(df: DataFrame, key: str, bits: str, threshold: float) -> DataFrame:
    """All pairs of distinct fingerprints with at least this similarity, exactly.

    (id_a, id_b, n_a, n_b, similarity): a fingerprint stands for its ``n`` rows and is named by the
    lowest key. A fingerprint that several rows have also appears with itself, similarity 1.
    """
    prints, _ = distinct_prints(df, key, bits)
    pairs = similar_pairs(prints, threshold, "n_rows")  # counts travel with the prefix rows: the pairs are not moved again
    similarity = F.col("shared") / (F.col("n_bits_a") + F.col("n_bits_b") - F.col("shared"))
    different = pairs.select("id_a", "id_b", F.col("n_rows_a").alias("n_a"), F.col("n_rows_b").alias("n_b"), similarity.alias("similarity"))
    copies = prints.filter("n_rows > 1").select(
        F.col("id").alias("id_a"), F.col("id").alias("id_b"),
        F.col("n_rows").alias("n_a"), F.col("n_rows").alias("n_b"), F.lit(1.0).alias("similarity"),
    )
    return different.unionByName(copies)


def _chunk_edges(prints: DataFrame) -> list:
    """Id bounds of chunks that grow geometrically, from approximate quantiles: any bounds are right,
    these keep the early chunks small."""
    total = prints.count()
    shares, size = [], FIRST_CHUNK
    while size < total:
        shares.append(size / total)
        size *= CHUNK_GROWTH
    if not shares:
        return []
    quantiles = prints.agg(F.percentile_approx("id", shares).alias("q")).first()["q"]
    return sorted(set(quantiles))


def _chunks(prints: DataFrame) -> list[DataFrame]:
    edges = _chunk_edges(prints)
    bounds = list(zip([None, *edges], [*edges, None]))
    out = []
    for low, high in bounds:
        part = prints
        if low is not None:
            part = part.filter(F.col("id") > low)
        if high is not None:
            part = part.filter(F.col("id") <= high)
        out.append(part)
    return out


def _both_ways(rows: DataFrame, others: DataFrame, threshold: float, *keep: str) -> tuple[DataFrame, DataFrame, str]:
    """Prefix rows of two tables that meet whichever side is the larger one, and the condition for it."""

    def sides(df: DataFrame, first_is_larger: bool) -> DataFrame:
        larger = _prefix(df, threshold, *keep, larger=True).withColumn("way", F.lit(0 if first_is_larger else 1))
        return larger.union(_prefix(df, threshold, *keep, larger=False).withColumn("way", F.lit(1 if first_is_larger else 0)))

    return sides(rows, True), sides(others, False), "a.way = b.way AND (a.n_bits >= b.n_bits) = (a.way = 0) AND "


def _without_near(rows: DataFrame, picks: DataFrame, similarity: float) -> DataFrame:
    """Rows that are not near any pick."""
    a, b, also = _both_ways(spread(rows), picks, similarity)
    near = _meet(a, b, _similar_condition(similarity, word_columns(rows)), "left_semi", also)
    return rows.join(near.select("id").distinct(), "id", "left_anti")


def _scan(edges: pa.Table) -> pa.Table:
    """The rows of a block that the scan skips for certain. A row is skipped if an earlier neighbour is picked, and
    picked if all earlier neighbours are skipped; neighbours of other blocks are unknown unless they
    have no earlier neighbour themselves (``first``)."""
    edges = edges.sort_by([("id_b", "ascending"), ("id_a", "ascending")])
    later, earlier, first = (edges.column(c).to_pylist() for c in ("id_b", "id_a", "first"))
    state: dict = {}  # True: picked, False: skipped; absent: unknown
    at = 0
    while at < len(later):
        row, stop, picked = later[at], at, True
        while stop < len(later) and later[stop] == row:
            known = True if first[stop] else state.get(earlier[stop])
            if known:
                picked = False
                break
            if known is None and picked:
                picked = None
            stop += 1
        if picked is not None:
            state[row] = picked
        while at < len(later) and later[at] == row:
            at += 1
    return pa.table({"id": pa.array([row for row, picked in state.items() if picked is False], edges.schema.field("id_b").type)})


def _first_independent(rows: DataFrame, similarity: float) -> DataFrame:
    """The rows a scan in id order would pick among ``rows``: the first maximal independent set.

    In each round rows behind one that has no earlier neighbour drop out. Then blocks of consecutive rows are
    scanned, each by itself, as far as it can be known, and what they skip drops out with its edges. The first
    block that has edges is always resolved to its end, since nothing before it is open, so there are at
    most as many rounds as blocks, however long a chain of neighbours is; mostly one or two do. Each
    round goes on from written tables.
    """
    edges = write_through(similar_pairs(rows, similarity).select("id_a", "id_b"), "edges")
    dropped: DataFrame | None = None
    count = edges.count()
    bounds = []
    if count > BLOCK_EDGES:
        shares = [i * BLOCK_EDGES / count for i in range(1, math.ceil(count / BLOCK_EDGES))]
        bounds = sorted(set(edges.agg(F.percentile_approx("id_b", shares).alias("q")).first()["q"]))
    block = F.lit(0) if not bounds else F.size(F.filter(F.array(*[F.lit(x) for x in bounds]), lambda x: x < F.col("id_b")))
    id_type = edges.schema["id_b"].dataType.simpleString()

    def without(gone: DataFrame) -> DataFrame:
        nonlocal dropped
        gone = write_through(gone, "gone")
        dropped = gone if dropped is None else dropped.unionByName(gone)
        left = edges.join(gone.withColumnRenamed("id", "id_b"), "id_b", "left_anti")
        return left.join(gone.withColumnRenamed("id", "id_a"), "id_a", "left_anti")

    def firsts() -> DataFrame:
        return edges.select(F.col("id_b").alias("id_a"), F.lit(True).alias("behind")).distinct()

    while not edges.isEmpty():
        if bounds:  # a row with very many earlier neighbours goes before the blocks are dealt
            marked = edges.join(firsts(), "id_a", "left")
            edges = write_through(without(marked.filter("behind IS NULL").select(F.col("id_b").alias("id")).distinct()), "edges")
        marked = edges.join(firsts(), "id_a", "left").select("id_a", "id_b", F.col("behind").isNull().alias("first"), block.alias("block"))
        edges = write_through(without(marked.groupBy("block").applyInArrow(_scan, f"id {id_type}")), "edges")
    return rows if dropped is None else rows.join(dropped, "id", "left_anti")


def leader_pick(df: DataFrame, key: str, bits: str, distance: float = PICK_DISTANCE) -> DataFrame:
    """Keys a scan in (numeric) key order picks when it skips rows within ``distance`` of an earlier pick.

    The result is that of the sequential scan. Chunks of growing size are resolved in key order;
    rows near an earlier pick leave before their chunk's own neighbours are looked for. So the large
    chunks meet the picks only, not one another's copies and near copies.
    """
    similarity = round(1.0 - distance, 12)
    table = write_through(df.select(key, bits), "fingerprints")
    prints, _ = distinct_prints(table, key, bits)
    picks: DataFrame | None = None
    for chunk in _chunks(prints):
        live = chunk if picks is None else write_through(_without_near(chunk, picks, similarity), "live")
        found = write_through(_first_independent(live, similarity), "picks")
        picks = found if picks is None else picks.unionByName(found)
    blank = table.filter(F.size(bits) == 0).select(key)
    return picks.select(F.col("id").alias(key)).unionByName(blank)


def similar_join(
    df: DataFrame, picks: DataFrame, key: str, bits: str, size: str,
    low: float = SIMILAR_LOW, high: float = SIMILAR_HIGH,
) -> DataFrame:
    """(key, similar_id): for each pick the lowest other row whose size is within the band and whose
    similarity lies in [low, high). A pick without one does not appear.

    Rows are searched in growing chunks of the key order; a pick leaves at its first match, so the
    large chunks meet only picks that are still without. Rows equal in fingerprint and size are one.
    """
    table = write_through(df.select(key, bits, size), "fingerprints")
    prints, numbering = distinct_prints(table, key, bits, also=[size])
    chosen = table.filter(F.size(bits) > 0).join(picks.select(key).distinct(), key, "left_semi")
    open_picks = number_bits(chosen.select(F.col(key).alias("id"), F.col(bits).alias("bits"), size), numbering)
    matched = None
    band = math.log(SIZE_HIGH)
    slot = lambda value: F.floor(F.log(F.greatest(value.cast("double"), F.lit(1e-9))) / F.lit(band))
    words = word_columns(prints)
    shared = _shared(words, "a", "b")
    condition = (
        f"a.`{size}` >= b.`{size}` * {SIZE_LOW}D AND a.`{size}` <= b.`{size}` * {SIZE_HIGH}D "
        f"AND {_similar_condition(low, words)} "
        f"AND ({shared}) / (a.n_bits + b.n_bits - ({shared})) < {high!r}D"
    )
    for chunk in _chunks(prints):
        if open_picks.isEmpty():
            break
        rows, wanted, ways = _both_ways(spread(chunk), open_picks, low, size)
        rows = rows.withColumn("slot", slot(F.col(size)))
        wanted = wanted.withColumn("slot", F.explode(F.sequence(slot(F.col(size) * SIZE_LOW), slot(F.col(size) * SIZE_HIGH))))
        met = _meet(rows, wanted, condition, also=f"a.slot = b.slot AND {ways}")
        found = met.select(F.col("b.id").alias("id"), F.col("a.id").alias("similar_id"))
        hits = write_through(found.groupBy("id").agg(F.min("similar_id").alias("similar_id")), "similar")
        matched = hits if matched is None else matched.unionByName(hits)
        open_picks = write_through(open_picks.join(hits.select("id"), "id", "left_anti"), "open")
    if matched is None:
        return picks.select(key, F.col(key).alias("similar_id")).limit(0)
    return matched.withColumnRenamed("id", key)


def merge_picks(picks: DataFrame, similar: DataFrame, key: str) -> DataFrame:
    """Picks and their similar rows, each key once."""
    return picks.select(key).union(similar.select(F.col("similar_id").alias(key))).distinct()


def expand_picks(df: DataFrame, picks: DataFrame, key: str, bits: str, size: str) -> DataFrame:
    """The rows of the picks and of their similar rows."""
    merged = merge_picks(picks, similar_join(df, picks, key, bits, size), key)
    return df.join(merged, key, "left_semi")
