"""Sorting, prefixes, samples and splits. Draws hash the row key, never the row position."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from qaprep.functions.hashing import draw, unit_draw
from qaprep.operators.filters import require_columns
from qaprep.session import new_folder

SPLITS = ("train", "valid", "test")
_BUCKET_BITS = 16


def curriculum_sort(df: DataFrame, *keys: str) -> DataFrame:
    """Easy rows first: few atoms, then low ids."""
    return df.orderBy(*(keys or ("num_atoms", "cid")))


def assign_splits(
    df: DataFrame, key: str, valid: float = 0.025, test: float = 0.025, seed: int = 42, column: str = "split"
) -> DataFrame:
    """Draw test / valid / train per row with the given shares."""
    if valid + test >= 1.0:
        raise ValueError("split fractions too large")
    return random_partition(df, key, {"test": test, "valid": valid, "train": 1.0 - valid - test}, seed, column)


def random_partition(
    df: DataFrame, key: str, shares: Mapping[str, float], seed: int = 42, column: str = "part"
) -> DataFrame:
    """Label each row with one of the parts; the shares must add up to one."""
    if abs(sum(shares.values()) - 1.0) > 1e-9:
        raise ValueError("shares must sum to 1.0")
    value = unit_draw(seed, F.col(key))
    names = list(shares)
    label, edge = None, 0.0
    for name in names[:-1]:
        edge += shares[name]
        label = F.when(value < F.lit(edge), name) if label is None else label.when(value < F.lit(edge), name)
    return df.withColumn(column, label.otherwise(names[-1]) if label is not None else F.lit(names[0]))


def seeded_sample(df: DataFrame, key: str | None, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the ones with the smallest draws. Without a key column the
    whole row is the key; equal rows are then interchangeable.

    A histogram of the draws (at most 65,536 rows) tells which buckets are in; only the bucket at
    the edge is ranked. No task sees more than its share, however large ``n`` is.
    """
    row_key = F.col(key) if key is not None else F.md5(F.to_json(F.struct("*")))
    drawn = df.withColumn("_key", row_key).withColumn("_draw", draw(seed, F.col("_key")))
    drawn = drawn.withColumn("_bucket", F.shiftright("_draw", 32 - _BUCKET_BITS))
    sizes = drawn.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    quota = sizes.filter(F.col("_before") < n).select("_bucket", (F.lit(n) - F.col("_before")).alias("_quota"), "_size")
    rows = drawn.join(F.broadcast(quota), "_bucket")
    whole = rows.filter(F.col("_size") <= F.col("_quota"))
    edge = rows.filter(F.col("_size") > F.col("_quota"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_draw", "_key"))
    edge = edge.withColumn("_rank", rank).filter(F.col("_rank") <= F.col("_quota")).drop("_rank")
    return whole.unionByName(edge).select(*df.columns)


def split_by_column(df: DataFrame, column: str = "split") -> dict[str, DataFrame]:
    """One frame per known split that has rows, without the split column. The input is read once: it is written
    by split, the write itself counts the rows, and each frame reads its own folder."""
    require_columns(df, [column])
    seen = Observation("splits")
    known = df.filter(F.col(column).isin(*SPLITS)).observe(seen, *[F.count_if(F.col(column) == name).alias(name) for name in SPLITS])
    path = new_folder(df.sparkSession, "splits")
    known.withColumn("_split", F.col(column)).drop(column).write.partitionBy("_split").parquet(path)
    rest = df.drop(column).schema
    return {name: df.sparkSession.read.schema(rest).parquet(f"{path}/_split={name}") for name in SPLITS if seen.get[name]}


def split_counts(df: DataFrame, column: str = "split") -> DataFrame:
    """Rows per known split; a split without rows does not appear."""
    return df.filter(F.col(column).isin(*SPLITS)).groupBy(column).agg(F.count("*").alias("n_rows"))


def sorted_set(items: Column) -> Column:
    """Distinct non-empty members in ascending order."""
    return F.array_sort(F.array_distinct(F.filter(items, lambda v: v != "")))
