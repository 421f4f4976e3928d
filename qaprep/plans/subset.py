"""From a compound table and a list of ids to the splits of a subset."""

from __future__ import annotations

from pyspark.sql import DataFrame

from qaprep.operators.filters import id_semi_join, nonblank
from qaprep.operators.sampling import assign_splits, curriculum_sort


def write_subset(
    df: DataFrame, ids: DataFrame, path: str, key: str = "cid", name: str = "iupac", order: tuple[str, ...] = ("num_atoms", "cid"),
    valid: float = 0.025, test: float = 0.025, seed: int = 42,
) -> None:
    """The listed rows that have a name, with a split drawn per row, easy rows first inside each split."""
    chosen = assign_splits(nonblank(id_semi_join(df, ids, key), name), key, valid, test, seed)
    curriculum_sort(chosen, "split", *order).write.partitionBy("split").parquet(path)
