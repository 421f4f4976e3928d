"""Stretches of words that repeat with a period, found by multi-scale minimizers.

A run of the smallest period q is a stretch in which words q apart are equal, of at least three periods and
``LEAST`` words, that neither neighbour extends. Periods below ``SHORT`` are found by direct lag scans:
the words are compared with themselves shifted by each lag. Longer periods are searched scale by scale,
each for the periods from w to 3w/2:

* A gram is w/2 words. A gram that has a period of a third of its length or less is not eligible; it lies in a
  run of a smaller scale, which is known by then.
* Of every window of grams the one with the least hash is selected. A window inside a run is selected
  alike one period later, so two selected equal grams lie q apart. The windows are so long that one
  without an eligible gram would have a period shorter than q (Fine and Wilf), and so short that a window
  and its copy fit into three periods. So no run is missed.
* Equal selected grams between w and 3w/2 apart are the seeds. Eligible grams overlap their copies little, so
  there are at most about nine partners for each, whatever the text. A seed is extended word by word.

Hashes only select seeds: words are numbered by their bytes and every run is confirmed on these numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaprep.llm.common import id_of, keyed, mix, powers, slices

LEAST = 24
#: Periods below this are found by direct scans, so that a gram of the first scale is ``LEAST`` words long.
SHORT = 48
_NEVER = np.iinfo(np.uint64).max


def stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of set flags."""
    at = np.flatnonzero(flags)
    if len(at) == 0:
        return at, at
    cut = np.flatnonzero(np.diff(at) > 1)
    return at[np.concatenate(([0], cut + 1))], at[np.concatenate((cut, [len(at) - 1]))] + 1


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of every window of ``width`` values, by doubling."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def sliding_greatest(values: np.ndarray, width: int) -> np.ndarray:
    return ~sliding_least(~values, width)


class GramHash:
    """Hashes of all grams of a number sequence, of any length."""

    def __init__(self, words: np.ndarray):
        self.sums = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(mix(words.astype(np.uint64) + np.uint64(1)) * powers(len(words))[: len(words)], out=self.sums[1:])
        self.inverse = powers(len(words) + 1, inverse=True)

    def grams(self, length: int) -> np.ndarray:
        return mix((self.sums[length:] - self.sums[:-length]) * self.inverse[: len(self.sums) - length])


def stretch_around(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The maximal stretch of places t around ``at`` whose words equal those at t + lag, in growing steps."""
    stop, step = at, 64
    while stop + lag < len(words):
        upto = min(stop + step, len(words) - lag)
        differs = np.flatnonzero(words[stop:upto] != words[stop + lag : upto + lag])
        if len(differs):
            stop += int(differs[0])
            break
        stop, step = upto, 2 * step
    start, step = at, 64
    while start > 0:
        downto = max(start - step, 0)
        differs = np.flatnonzero(words[downto:start] != words[downto + lag : start + lag])
        if len(differs):
            start = downto + int(differs[-1]) + 1
            break
        start, step = downto, 2 * step
    return start, stop


def seeds(selected: np.ndarray, keys: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
    """(lag, place) of the selected grams with an equal one from ``low`` to below ``high`` places later."""
    order = np.argsort(keys, kind="stable")
    keys, places, out, step = keys[order], selected[order], [], 1
    while step < len(keys):
        apart = places[step:] - places[:-step]
        near = (keys[step:] == keys[:-step]) & (apart < high)
        if not near.any():
            break
        near &= apart >= low
        out += zip(apart[near].tolist(), places[:-step][near].tolist(), strict=True)
        step += 1
    return sorted(out)


def find_runs(words: np.ndarray, lengths: np.ndarray, least: int = LEAST, short: int = SHORT) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs in the rows of ``words``: numbers that no two rows share, row after row."""
    found: dict[tuple[int, int], int] = {}
    for lag in range(1, min(short, int(lengths.max(initial=0)) // 3 + 1)):
        starts, ends = stretches(words[lag:] == words[:-lag])
        long = ends - starts >= max(least - lag, 2 * lag)
        for span in zip(starts[long].tolist(), (ends[long] + lag).tolist(), strict=True):
            found.setdefault(span, lag)  # lags rise: the first is the smallest period
    low, of_row = short, np.repeat(lengths, lengths)
    while 3 * low <= lengths.max(initial=0):
        high, gram = low + low // 2, low // 2
        window = high - gram + gram // 3 + 1
        kept = np.flatnonzero(of_row >= 3 * low)  # rows that can hold such a run
        own = words[kept]
        hashes = GramHash(own).grams(gram)
        if len(hashes) >= window:
            to_own = np.searchsorted(kept, np.array([(s, e - gram + 1) for (s, e), q in found.items() if q <= gram // 3 and e - s >= gram and of_row[s] >= 3 * low], dtype=np.int64).reshape(-1, 2))
            covered = np.zeros(len(own) + 1, dtype=np.int64)
            np.add.at(covered, to_own[:, 0], 1)
            np.add.at(covered, to_own[:, 1], -1)
            hashes = np.where(np.cumsum(covered)[: len(hashes)] > 0, _NEVER, hashes)
            mins = np.concatenate((np.zeros(window - 1, np.uint64), sliding_least(hashes, window), np.zeros(window - 1, np.uint64)))
            selected = np.flatnonzero((sliding_greatest(mins, window) == hashes) & (hashes != _NEVER))
            last = (0, 0, 0)
            for lag, at in seeds(selected, hashes[selected], low, high):
                if lag == last[0] and at < last[2]:
                    continue
                start, stop = stretch_around(own, at, lag)
                last = (lag, start, stop)
                if stop - start + lag >= max(least, 3 * lag):
                    found.setdefault((int(kept[start]), int(kept[start]) + stop - start + lag), lag)
        low = high
    return sorted((s, e, q) for (s, e), q in found.items())


def _numbered(texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of each text, their numbers (equal words of a text alike, those of others different), words per text."""
    split, numbers, base = [t.split() for t in texts], [], 0  # bytes: at blank, tab and the four line ends
    for words in split:
        known: dict[bytes, int] = {}
        numbers += [known.setdefault(w, base + len(known)) for w in words]
        base += len(known)
    return split, np.array(numbers, dtype=np.int64), np.array([len(w) for w in split], dtype=np.int64)


def _run(least: int, short: int):
    kinds = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts, numbers, lengths = _numbered(batch.column("text").cast(pa.binary()).to_pylist())
            firsts = np.concatenate(([0], np.cumsum(lengths)))
            runs: list[list[dict[str, int]]] = [[] for _ in texts]
            gone = np.zeros(len(numbers) + 1, dtype=np.int64)
            for start, end, period in find_runs(numbers, lengths, least, short):
                row = int(np.searchsorted(firsts, start, side="right")) - 1
                runs[row].append({"start": start - int(firsts[row]), "length": end - start, "period": period})
                gone[start + period] += 1
                gone[end] -= 1
            stays = np.cumsum(gone)[:-1] == 0
            kept = []
            for row, words in enumerate(texts):
                if runs[row]:
                    words = [w for w, s in zip(words, stays[firsts[row] : firsts[row + 1]].tolist(), strict=True) if s]
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(lengths), pa.array(runs, kinds), pa.array(kept, pa.binary())], names=["key", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST, short: int = SHORT) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs``.

    ``runs``: start, length and period of each run in words, by start, then period. ``collapsed``: the words
    left, joined by one blank, when of every run only its first period stays (a word that any run
    repeats goes). ``short``: twice ``least`` or more; results don't depend on it. A null text counts as empty
    and has no runs; white space has none either. Rows are read one by one: repeated rows and null ids
    give a row each, an empty table gives none, other columns are not read. A text of any length is one row
    of one task; the work on it grows with its length times the logarithm of the length."""
    rows = keyed(docs).mapInArrow(_run(least, short), "key bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary")
    return rows.select(id_of(F.col("key")).alias("doc_id"), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))
