"""Seeded draws that depend on the row key only, so they survive any repartitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_RANGE = 1 << 32


def draw(seed: int | str, *keys: Column) -> Column:
    """A 32-bit number from ``md5(seed:key[:key...])`` (first eight hex digits)."""
    text = F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def unit_draw(seed: int | str, *keys: Column) -> Column:
    """The same draw scaled to [0, 1)."""
    return draw(seed, *keys) / F.lit(float(DRAW_RANGE))
