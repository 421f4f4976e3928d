"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a slice; keys with more are cut.
HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, on: Sequence[str]) -> list[tuple[int, int]]:
    """(key hash, slices) of every key with more than ``HOT_ROWS`` rows. Counting combines map-side, and there
    is at most one such key per ``HOT_ROWS`` rows of the table."""
    counts = df.groupBy(F.xxhash64(*on).alias("code")).agg(F.count("*").alias("n")).filter(F.col("n") > HOT_ROWS)
    return [(r.code, -(-r.n // HOT_ROWS)) for r in counts.toLocalIterator()]


def sliced_join(left: DataFrame, right: DataFrame, on: Sequence[str], by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``left`` to a ``right`` that has one row per key.

    The rows of a hot key are cut into slices by a hash of the columns ``by``, and its right row is
    copied for each slice. So no task gets a whole hot key, whatever its share.
    """
    hot = hot_keys(left, on)
    if not hot:
        return left.join(right, list(on), how)
    table = F.broadcast(left.sparkSession.createDataFrame(hot, "_code long, _slices long"))

    def sliced(df: DataFrame) -> DataFrame:
        coded = df.withColumn("_code", F.xxhash64(*on)).join(table, "_code", "left")
        return coded.withColumn("_slices", F.coalesce("_slices", F.lit(1).cast("bigint"))).drop("_code")

    spread = sliced(left).withColumn("_slice", F.pmod(F.xxhash64(*by), F.col("_slices"))).drop("_slices")
    zero = F.lit(0).cast("bigint")
    copied = sliced(right).withColumn("_slice", F.explode(F.sequence(zero, F.col("_slices") - 1))).drop("_slices")
    return spread.join(copied, [*on, "_slice"], how).drop("_slice")
