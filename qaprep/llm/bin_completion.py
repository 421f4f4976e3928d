"""Best-fit packing of whole documents by bin completion.

A document's ids and its end id are one piece; longer documents are cut into pieces of ``length``, the last of
which may be shorter. Pieces that fill a sequence are one. The others are dealt at random to groups, and
each group is packed into as few sequences as the search finds:

* the best-fit decreasing packing is the first incumbent; it is done if it meets the lower bound;
* otherwise branch and bound: the largest piece left opens a sequence, the undominated fillings of the
  room beside it are tried in the order of their waste, and a branch ends when the waste so far exceeds
  what a packing with one sequence less than the incumbent may waste. Whatever is left at the search's
  limit is packed by best fit, and a better packing found becomes the incumbent.

The search needs only the sizes. A group keeps its well filled sequences and hands on the pieces of the
emptiest ones; these meet those of other groups in the next round, until one group is left, so what a
group wastes at its end is not wasted for good.

A filling is dominated if a larger piece that is left out could take the place of some of its pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaprep.llm.common import id_of, keyed, slices, text_buffer
from qaprep.llm.tokens import WordEncoder
from qaprep.session import write_through

LENGTH = 2048
END_ID = 0
#: Pieces of a group. A group hands on at most one piece of ``HANDED_ON``.
GROUP = 16384
HANDED_ON = 8
#: Limits of the search in a group: sequences opened, fillings tried per sequence, steps to list them.
NODES = 2000
FILLINGS = 6
STEPS = 250

Bins = list[list[int]]


def best_fit_decreasing(sizes: list[int], room: int) -> Bins:
    """Sizes in falling order, each into the fullest bin with room for it."""
    bins: Bins = []
    with_room: list[list[int]] = [[] for _ in range(room + 1)]
    mask = 0  # bit r: some bin has room for r
    for size in sorted(sizes, reverse=True):
        fits = mask >> size
        if fits:
            left = (fits & -fits).bit_length() - 1 + size
            number = with_room[left].pop()
            if not with_room[left]:
                mask ^= 1 << left
            bins[number].append(size)
            left -= size
        else:
            number, left = len(bins), room - size
            bins.append([size])
        with_room[left].append(number)
        mask |= 1 << left
    return bins


def lower_bound(counts: np.ndarray, room: int) -> int:
    """Bins that any packing needs: those of the total, or, for some k, those that the pieces above room - k
    and above room / 2 open, and what the pieces of k or more can't find place for in these."""
    sizes = np.arange(room + 1)
    numbers, totals = np.cumsum(counts), np.cumsum(counts * sizes)
    best = -(-int(totals[room]) // room)
    k = np.arange(0, room // 2 + 1)
    upto = lambda table, at: table[at]
    alone = numbers[room] - upto(numbers, room - k)
    halves = upto(numbers, room - k) - numbers[room // 2]
    halves_total = upto(totals, room - k) - totals[room // 2]
    small = totals[room // 2] - np.where(k > 0, totals[np.maximum(k - 1, 0)], 0)
    more = np.maximum(0, -(-(small - (halves * room - halves_total)) // room))
    return max(best, int((alone + halves + more).max()))


def fillings(counts: dict[int, int], left: int, waste: int, most: int = FILLINGS, steps: int = STEPS) -> tuple[list[tuple[int, ...]], bool]:
    """Undominated sets of the sizes in ``counts`` that fill ``left`` but for ``waste`` at most, the fullest first,
    larger sizes first among equals; and whether these are all, or the limits ended the search."""
    sizes = sorted((s for s, n in counts.items() if n and s <= left), reverse=True)
    below = [0] * (len(sizes) + 1)  # what this and all smaller sizes add up to
    for i in range(len(sizes) - 1, -1, -1):
        below[i] = below[i + 1] + sizes[i] * counts[sizes[i]]
    mask = 0  # bit s: there is a piece of the size s
    for s in sizes:
        mask |= 1 << s
    out: list[tuple[int, ...]] = []
    stack: list[tuple[int, int, tuple[int, ...]]] = [(0, left, ())]
    while stack and steps and len(out) < most:
        steps -= 1
        at, free, chosen = stack.pop()
        while at < len(sizes) and sizes[at] > free:
            at += 1
        if free - below[at] > waste:
            continue
        if at == len(sizes):
            gone = {s for s in chosen if counts[s] == chosen.count(s)}
            if not dominated(chosen, free, mask & ~sum(1 << s for s in gone)):
                out.append(chosen)
            continue
        size = sizes[at]
        fit = min(counts[size], free // size)
        stack.extend((at + 1, free - n * size, chosen + (size,) * n) for n in range(fit + 1))
    out.sort(key=lambda f: (-sum(f), [-s for s in f]))
    return out, not stack


def smeared(bits: int, by: int) -> int:
    """The bits and those up to ``by`` places above each of them."""
    done = 0
    while done < by:
        step = min(done + 1, by - done)
        bits |= bits << step
        done += step
    return bits


def dominated(chosen: tuple[int, ...], free: int, left_out: int) -> bool:
    """Whether a size left out (a bit of ``left_out``) fits into the room left, or can replace a smaller chosen one
    or several chosen ones that are no larger together, so that it fits."""
    sums = 1  # bit v: some of the chosen sizes add up to v
    several = 0  # the same for two or more of them
    for s in chosen:
        several |= several << s | (sums & ~1) << s
        sums |= sums << s
    return bool(left_out & (smeared(several, free) | (smeared(sums, free - 1) << 1 if free else 0)))


def complete(sizes: list[int], room: int, nodes: int = NODES, width: int = FILLINGS, steps: int = STEPS) -> Bins:
    """As few bins of ``room`` as the search finds."""
    best = best_fit_decreasing(sizes, room)
    table = np.bincount(np.asarray(sizes, dtype=np.int64), minlength=room + 1) if sizes else np.zeros(room + 1, np.int64)
    bound, total = lower_bound(table, room), sum(sizes)
    if len(best) <= bound:
        return best
    counts = {s: int(n) for s, n in enumerate(table.tolist()) if n}
    allowed = (len(best) - 1) * room - total  # waste of a packing that beats the incumbent
    opened: Bins = []
    trials: list[Iterator[tuple[int, ...]]] = []
    wasted = [0]

    def take(chosen: list[int], sign: int) -> None:
        for s in chosen:
            counts[s] = counts.get(s, 0) - sign
            if not counts[s]:
                del counts[s]

    def improve(tried: Bins) -> None:
        nonlocal best, allowed
        if len(tried) < len(best):
            best = [list(b) for b in tried]
            allowed = (len(best) - 1) * room - total

    def trial() -> Iterator[tuple[int, ...]]:
        largest = max(counts)
        counts[largest] -= 1
        found, _ = fillings(counts, room - largest, allowed - wasted[-1], width, steps)
        counts[largest] += 1
        return iter([(largest, *f) for f in found])

    trials.append(trial())
    while trials and nodes and len(best) > bound:
        chosen = next(trials[-1], None)
        if chosen is None:
            trials.pop()
            if opened:
                wasted.pop()
                take(opened.pop(), -1)
            continue
        waste = wasted[-1] + room - sum(chosen)
        if waste > allowed:
            continue
        nodes -= 1
        take(list(chosen), 1)
        opened.append(list(chosen))
        wasted.append(waste)
        if not counts:
            improve(opened)
            take(opened.pop(), -1)
            wasted.pop()
        else:
            trials.append(trial())
    if opened and counts and len(best) > bound:  # the limit: the rest by best fit
        improve(opened + best_fit_decreasing([s for s, n in counts.items() for _ in range(n)], room))
    return best


def _cut(path: str, length: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path, spaced=False)
        dtype = encoder.dtype if end_id < 1 << (8 * encoder.dtype.itemsize) else np.dtype("<u4")
        end, step, width = np.array([end_id], dtype=dtype).tobytes(), length * dtype.itemsize, dtype.itemsize
        place = TaskContext.get().partitionId() << 40
        for batch in slices(batches, "text"):
            keys, numbers, pieces = [], [], []
            for key, ids in zip(batch.column("key").to_pylist(), encoder.encode(batch.column("text").to_pylist()), strict=True):
                raw = (ids if dtype == encoder.dtype else np.frombuffer(ids, encoder.dtype).astype(dtype).tobytes()) + end
                for number, at in enumerate(range(0, len(raw), step)):
                    keys.append(key)
                    numbers.append(number)
                    pieces.append(raw[at : at + step])
            n = len(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(place, place + n)), pa.array(keys, pa.int64()), pa.array(numbers, pa.int32()), pa.array([len(p) // width for p in pieces], pa.int64()), pa.array(pieces, pa.binary())],
                names=["place", "key", "piece", "length", "ids"],
            )
            place += n

    return run


def _pack_group(room: int, round_no: int, last: bool):
    """Sequences of a group's pieces. Unless it is the ``last`` round, the emptiest sequences that together hold
    at most one piece of ``HANDED_ON`` stay open: their pieces come out without a sequence."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        places, sizes = table.column("place").to_numpy(), table.column("length").to_numpy()
        bins = complete(sizes.tolist(), room)
        bins.sort(key=sum, reverse=True)
        stay, open_pieces = len(bins), 0
        while not last and stay and sum(bins[stay - 1]) < room and open_pieces + len(bins[stay - 1]) <= len(sizes) // HANDED_ON:
            stay -= 1
            open_pieces += len(bins[stay])
        of_size: dict[int, list[int]] = {}
        for at, size in enumerate(sizes.tolist()):
            of_size.setdefault(size, []).append(at)
        base = (round_no << 56) | (table.column("bucket")[0].as_py() << 20)
        order, sequence, offset = [], [], []
        for number, pieces in enumerate(bins):
            filled = 0
            for size in pieces:
                order.append(of_size[size].pop())
                sequence.append(base + number if number < stay else None)
                offset.append(filled)
                filled += size
        return pa.table({"place": pa.array(places[order]), "length": pa.array(sizes[order]), "sequence_id": pa.array(sequence, pa.int64()), "offset": pa.array(offset, pa.int64())})

    return run


def pack_whole(docs: DataFrame, path: str, length: int = LENGTH, group: int = GROUP, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, sequence_id, offset, ids`` of every piece.

    ``ids`` are little-endian unsigned 32-bit integers. A document of at most ``length`` ids is one piece; of a longer
    one all pieces but the last have ``length`` ids. ``offset`` is the place in the sequence. A null or empty
    text is the end id alone. Repeated rows and null ids are documents of their own, equal pieces are told apart
    by their place in the table; an empty table gives no pieces, other columns are not read."""
    pieces = write_through(keyed(docs).mapInArrow(_cut(path, length, end_id), "place bigint, key bigint, piece int, length bigint, ids binary"), "pieces")
    placed = pieces.filter(F.col("length") == length).select("place", (-1 - F.col("place")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    left = pieces.filter(F.col("length") < length).select("place", "length")
    count, round_no = left.count(), 1
    while count:
        groups = -(-count // group)
        dealt = left.withColumn("bucket", F.pmod(F.xxhash64("place", F.lit(round_no)), F.lit(groups)))
        packed = dealt.groupBy("bucket").applyInArrow(_pack_group(length, round_no, groups == 1), "place bigint, length bigint, sequence_id bigint, offset bigint")
        packed = write_through(packed, "packed")
        placed = placed.union(packed.filter("sequence_id IS NOT NULL").select("place", "sequence_id", "offset"))
        left = packed.filter("sequence_id IS NULL").select("place", "length")
        count, round_no = left.count(), round_no + 1
    out = pieces.join(placed, "place")
    start = F.col("piece").cast("bigint") * length
    rows = out.select(id_of(F.col("key")).alias("doc_id"), "piece", start.alias("start"), "length", "sequence_id", "offset", "ids")
    return rows.mapInArrow(_widened, rows.schema)


def _widened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of two bytes as such of four, a batch at once."""
    for batch in batches:
        data, offsets = text_buffer(batch.column("ids"))
        lengths = batch.column("length").to_numpy()
        if lengths.sum() * 4 == len(data):
            yield batch
            continue
        wide = pa.py_buffer(data.view("<u2").astype("<u4").tobytes())
        ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer((2 * offsets).astype(np.int64).tobytes()), wide]).cast(pa.binary())
        yield batch.set_column(batch.schema.get_field_index("ids"), "ids", ids)
