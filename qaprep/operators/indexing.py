"""Row numbers over whole tables and inside groups, without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaprep.operators.joins import sliced_join
from qaprep.session import write_through

# Up to here every split sends its first rows to one task; beyond it the rows stay distributed.
TOP_K_ROWS = 1000


def global_index(df: DataFrame, order: Sequence[Column | str], name: str = "row_no") -> DataFrame:
    """Zero-based position of every row in ``order``, which must end in a unique key.

    The rows are range-partitioned and sorted, so equal leading keys do not gather in one task;
    a position inside the partition is attached and the table written. Then one number per
    partition (its size) is turned into offsets: that table has one row per task, which bounds
    the broadcast.
    """
    placed = df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    table = write_through(placed, "index")
    sizes = table.groupBy(F.shiftright("_place", 33).alias("_part")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        table.withColumn("_part", F.shiftright("_place", 33))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_base") + inside)
        .drop("_part", "_base", "_place")
    )


def group_positions(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column | str], name: str = "member_no"
) -> DataFrame:
    """Zero-based position inside each group, also for groups no task could hold. Rows without a
    group are left out.

    The global order by (groups, order) keeps a group contiguous; its first position is a plain
    minimum, which combines map-side.
    """
    indexed = global_index(df, [*groups, *order], "_global")
    starts = indexed.groupBy(*groups).agg(F.min("_global").alias("_start"))
    joined = sliced_join(indexed, starts, groups, ["_global"])
    return joined.select(*df.columns, (F.col("_global") - F.col("_start")).alias(name))


def top_per_group(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int, salt: Column, salts: int = 256
) -> DataFrame:
    """The first ``n`` rows of each group. A first cut inside (group, salt) spreads a hot group over
    many tasks; what is left for the second cut is at most ``salts * n`` rows per group."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(salts)))
    first = Window.partitionBy(*groups, "_salt").orderBy(*order)
    second = Window.partitionBy(*groups).orderBy(*order)
    cut = salted.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") <= n)
    return (
        cut.drop("_salt", "_rank").withColumn("_rank", F.row_number().over(second)).filter(F.col("_rank") <= n).drop("_rank")
    )


def first_rows(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows in ``order`` (which must end in a unique key)."""
    if n <= TOP_K_ROWS:
        return df.orderBy(*order).limit(n)
    return global_index(df, order, "_row").filter(F.col("_row") < n).drop("_row")


def take_rows(df: DataFrame, picks: DataFrame, key: str, pick_no: str = "pick_no") -> DataFrame:
    """The picked rows, numbered in pick order; ``picks`` holds (key, pick_no)."""
    return df.join(picks.select(key, pick_no), key, "inner")
