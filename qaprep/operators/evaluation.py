"""Scoring of predictions and profiles of tokenised datasets."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qaprep.functions.text import answers_match, norm_tagged
from qaprep.functions.tokens import MASKED, PAD, decode_ids, decode_labels, sanitize_ids
from qaprep.operators.indexing import first_rows

ZERO = "0"


def align_predictions(gold: DataFrame, predictions: DataFrame, key: str = "example_id") -> DataFrame:
    """Pair gold rows and predictions by example key."""
    return gold.join(predictions, key)


def with_match(df: DataFrame, pred: str = "prediction", gold: str = "gold", json_aware: bool = True) -> DataFrame:
    """Normalised answers and whether they agree."""
    normal = df.withColumns({"pred_answer": norm_tagged(F.col(pred)), "gold_answer": norm_tagged(F.col(gold))})
    return normal.withColumn("is_match", answers_match(F.col("pred_answer"), F.col("gold_answer"), json_aware))


def share(hit: Column) -> Column:
    """Share of rows for which ``hit`` holds; 0 without rows."""
    return F.coalesce(F.avg(hit.cast("double")), F.lit(0.0))


def exact_match(matched: DataFrame) -> DataFrame:
    return matched.agg(share(F.col("is_match")).alias("exact_match"))


def _ratio(correct: Column, total: Column) -> Column:
    return F.try_divide(correct.cast("double"), total)


def accuracy_by_question(df: DataFrame, question: str = "question_id", json_aware: bool = False, **columns: str) -> DataFrame:
    """Per question: examples, correct ones, accuracy; the same for gold ``0`` and for the others."""
    rows = with_match(df, json_aware=json_aware, **columns)
    zero, hit = F.col("gold_answer") == ZERO, F.col("is_match")
    counted = rows.groupBy(question).agg(
        F.count("*").alias("total"),
        F.count_if(hit).alias("correct"),
        F.count_if(zero).alias("zero_total"),
        F.count_if(zero & hit).alias("zero_correct"),
    )
    counted = counted.withColumns(
        {
            "non_zero_total": F.col("total") - F.col("zero_total"),
            "non_zero_correct": F.col("correct") - F.col("zero_correct"),
        }
    )
    return counted.withColumns(
        {f"{p}accuracy": _ratio(F.col(f"{p}correct"), F.col(f"{p}total")) for p in ("", "zero_", "non_zero_")}
    )


def accuracy_summary(df: DataFrame, json_aware: bool = False, **columns: str) -> DataFrame:
    """Totals for gold ``0``, for the others, and overall."""
    rows = with_match(df, json_aware=json_aware, **columns).withColumn(
        "answer_type", F.when(F.col("gold_answer") == ZERO, "zero").otherwise("non_zero")
    )
    summed = rows.rollup("answer_type").agg(
        F.count("*").alias("total"), F.count_if("is_match").alias("correct"), F.grouping("answer_type").alias("_all")
    )
    named = summed.withColumn("answer_type", F.when(F.col("_all") == 1, "overall").otherwise(F.col("answer_type")))
    return named.filter("total > 0").drop("_all").withColumn("accuracy", _ratio(F.col("correct"), F.col("total")))


def score_predictions(df: DataFrame, pred_ids: str = "pred_ids", labels: str = "labels") -> DataFrame:
    """Token ids in, exact match out, in one plan."""
    texts = df.select(
        decode_ids(sanitize_ids(F.col(pred_ids))).alias("prediction"),
        decode_ids(sanitize_ids(F.col(labels))).alias("gold"),
    )
    return exact_match(with_match(texts))


def example_log(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """The first few pairs, for a look."""
    return first_rows(df, order, n)


def _marks(ids: Column, value: int) -> Column:
    return F.size(ids) - F.size(F.array_remove(ids, value))


def _spread(count: Column, prefix: str) -> list[Column]:
    zero = F.lit(0.0)
    return [
        F.coalesce(f(count).cast("double"), zero).alias(f"{prefix}{name}")
        for name, f in (("min", F.min), ("max", F.max), ("mean", F.avg))
    ]


def padding_stats(df: DataFrame, ids: str = "input_ids", pad: int = PAD) -> DataFrame:
    """Smallest, largest and mean number of padding ids per row. Padding and end of text share one
    id, so the end id is counted too."""
    return df.agg(*_spread(_marks(F.col(ids), pad), "pad_"))


def label_mask_stats(df: DataFrame, labels: str = "labels") -> DataFrame:
    return df.agg(*_spread(_marks(F.col(labels), MASKED), "masked_"))


def dataset_profile(df: DataFrame, groups: Sequence[str] = ("dataset", "split")) -> DataFrame:
    """Rows, padding and mask statistics of every dataset and split in one pass."""
    return df.groupBy(*groups).agg(
        F.count("*").alias("n_rows"),
        *_spread(_marks(F.col("input_ids"), PAD), "pad_"),
        *_spread(_marks(F.col("labels"), MASKED), "masked_"),
    )


_PARTIAL = (
    "dataset string, split string, n bigint, pad_sum bigint, pad_min bigint, pad_max bigint, mask_sum bigint, mask_min bigint, mask_max bigint, "
    "samples array<struct<draw: string, input_ids: array<int>, labels: array<int>>>"
)


def _partial_profile(samples: int, seed: int, pad: int):
    """Counts of a partition's rows by dataset and split, and those of its rows that are drawn first."""

    def counts(column: pa.Array, value: int) -> np.ndarray:
        lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        hits = (column.flatten().fill_null(-1).to_numpy(zero_copy_only=False) == value).astype(np.int64)
        before = np.concatenate(([0], np.cumsum(hits)))
        ends = np.cumsum(lengths)
        return before[ends] - before[ends - lengths]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, list[int]] = {}
        first: dict[tuple, list[tuple]] = {}
        for batch in batches:
            pads, masks = counts(batch.column("input_ids"), pad), counts(batch.column("labels"), MASKED)
            keys = list(zip(batch.column("dataset").to_pylist(), batch.column("split").to_pylist(), strict=True))
            for key in set(keys):
                own = np.array([k == key for k in keys])
                p, m = pads[own], masks[own]
                now = [len(p), int(p.sum()), int(p.min()), int(p.max()), int(m.sum()), int(m.min()), int(m.max())]
                old = sums.get(key)
                merge = (int.__add__, int.__add__, min, max, int.__add__, min, max)
                sums[key] = now if old is None else [f(a, b) for f, a, b in zip(merge, old, now, strict=True)]
            for row, key in enumerate(keys):
                ids, labels = batch.column("input_ids")[row].as_py() or [], batch.column("labels")[row].as_py() or []
                draw = hashlib.md5(f"{seed}:{ids}:{labels}".encode()).hexdigest()
                chosen = first.setdefault(key, [])
                heapq.heappush(chosen, (tuple(-ord(c) for c in draw), draw, ids, labels))
                if len(chosen) > samples:
                    heapq.heappop(chosen)
        rows = [
            {"dataset": k[0], "split": k[1], "n": s[0], "pad_sum": s[1], "pad_min": s[2], "pad_max": s[3], "mask_sum": s[4], "mask_min": s[5], "mask_max": s[6],
             "samples": [{"draw": d, "input_ids": i, "labels": x} for _, d, i, x in first[k]]}
            for k, s in sums.items()
        ]
        if rows:
            entry = pa.struct([("draw", pa.string()), ("input_ids", pa.list_(pa.int32())), ("labels", pa.list_(pa.int32()))])
            numbers = [(c, pa.int64()) for c in ("n", "pad_sum", "pad_min", "pad_max", "mask_sum", "mask_min", "mask_max")]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("dataset", pa.string()), ("split", pa.string()), *numbers, ("samples", pa.list_(entry))]))

    return run


def saved_profile(spark: SparkSession, path: str, samples: int = 3, seed: int = 42, pad: int = PAD) -> DataFrame:
    """Profile of a dataset that ``build_dataset`` wrote: for each dataset (``full``, ``minimal``) and split the columns, rows,
    padding and mask statistics, and ``samples`` rows (draw, input_ids, labels), which ``decoded_samples`` decodes.

    Counts and samples come from one pass. A sample is the rows with the smallest seeded hash, so the samples of
    parts merge: a task hands on no more than ``samples`` rows of a split, whatever it has read."""
    parts = []
    for name in ("full", "minimal"):
        saved = spark.read.parquet(f"{path}/{name}")
        columns = F.lit(",".join(sorted(c for c in saved.columns if c != "split")))
        found = saved.select(F.lit(name).alias("dataset"), "split", "input_ids", "labels").mapInArrow(_partial_profile(samples, seed, pad), _PARTIAL)
        parts.append(found.withColumn("columns", columns))
    first = F.slice(F.array_sort(F.flatten(F.collect_list("samples"))), 1, samples)
    mean = lambda total: F.sum(total) / F.sum("n")
    return parts[0].unionByName(parts[1]).groupBy("dataset", "split", "columns").agg(
        F.sum("n").alias("n_rows"),
        F.min("pad_min").cast("double").alias("pad_min"), F.max("pad_max").cast("double").alias("pad_max"), mean("pad_sum").alias("pad_mean"),
        F.min("mask_min").cast("double").alias("masked_min"), F.max("mask_max").cast("double").alias("masked_max"), mean("mask_sum").alias("masked_mean"),
        first.alias("samples"),
    )


def decoded_samples(profile: DataFrame) -> DataFrame:
    """(dataset, split, sample_no, input, labels) of the rows that ``saved_profile`` drew, decoded."""
    rows = profile.select("dataset", "split", F.posexplode("samples").alias("sample_no", "_s"))
    return rows.select("dataset", "split", "sample_no", decode_ids(F.col("_s.input_ids")).alias("input"), decode_labels(F.col("_s.labels")).alias("labels"))
