"""A value that several parts of an expression share, worked out once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row. Inside array functions Spark works out
    an outer expression again for every element; a bound one is a plain variable."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
