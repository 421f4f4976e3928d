"""Reaction lines: parts without atom maps, and deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaprep.operators.indexing import first_rows
from qaprep.operators.sampling import sorted_set

PARTS = ("reactants", "agents", "products")


def reaction_part(text: Column) -> Column:
    """Sorted distinct components; map numbers are dropped."""
    return sorted_set(F.split(F.regexp_replace(text, r":[0-9]+\]", "]"), r"\."))


def parse_reactions(df: DataFrame, line: str = "value") -> DataFrame:
    """Attach the three component lists; lines that are not ``a>b>c`` are skipped."""
    sides = F.split(F.trim(F.col(line)), ">")
    valid = df.filter((F.size(sides) == 3) & ~F.col(line).rlike(r"\s\S"))
    return valid.withColumns({name: reaction_part(F.get(sides, F.lit(i))) for i, name in enumerate(PARTS)})


def reaction_dedup(df: DataFrame, order: str, limit: int | None = None) -> DataFrame:
    """The first row of each reaction; ``limit`` counts distinct ones. Copies combine map-side."""
    unique = df.groupBy(*PARTS).agg(F.min(order).alias(order))
    return unique if limit is None else first_rows(unique, [order], limit)
