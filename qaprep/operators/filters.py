"""Row and column filters of the generation path."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaprep.functions.text import as_text, strip
from qaprep.operators.joins import sliced_join


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, null_count), one pass over the table."""
    names = list(columns or df.columns)
    counted = df.agg(*[(F.count(F.lit(1)) - F.count(F.col(f"`{c}`"))).alias(c) for c in names])
    pairs = ", ".join(f"'{c}', `{c}`" for c in names)
    return counted.selectExpr(f"stack({len(names)}, {pairs}) AS (column_name, null_count)")


def drop_null_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Remove every column that holds a null. Only the counts, one per column, reach the driver."""
    counts = {row.column_name: row.null_count for row in null_counts(df).collect()}
    return df.drop(*[c for c in df.columns if counts[c] > 0 and c not in keep])


def range_filter(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Inclusive bounds, either may be open; a null value drops the row."""
    if low is None and high is None:
        return df
    require_columns(df, [column])
    value = F.col(column)
    tests = ([value >= F.lit(low)] if low is not None else []) + ([value <= F.lit(high)] if high is not None else [])
    return df.filter(reduce(Column.__and__, tests))


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def nonblank(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & (strip(F.col(column).cast("string")) != ""))


def not_empty(df: DataFrame, column: str) -> DataFrame:
    """Drop empty and null values, keep blanks."""
    return df.filter(F.col(column) != "")


def clean_molecules(df: DataFrame, min_atoms: int = 3) -> DataFrame:
    """Single-component, unlabelled, named molecules of at least ``min_atoms`` atoms."""
    return df.filter(
        (F.col("num_atoms") >= min_atoms)
        & ~F.contains("smiles", F.lit("."))
        & ~F.contains("iupac", F.lit("None"))
        & ~F.contains("smiles", F.lit("[2H]"))
    )


def answers_valid(columns: Sequence[str]) -> Column:
    """True when every answer, taken as text, has something in it; a null reads ``None``."""
    return reduce(Column.__and__, [strip(as_text(F.col(c))) != "" for c in columns])


def replace_answers(df: DataFrame, answers: dict[str, Column], valid: Column | None = None) -> DataFrame:
    """Attach answer columns behind the others; a column of the same name moves to the end."""
    computed = df.withColumns({f"_new_{name}": value for name, value in answers.items()})
    if valid is not None:
        computed = computed.filter(valid)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in answers]
    return computed.select(*kept, *[F.col(f"`_new_{name}`").alias(name) for name in answers])


# Reasons a fetched record is turned down, in the order they are tested.
THROTTLE_WORDS = ("yellow", "red", "black")
INVALID_RECORD = "Invalid record number"
WANTED_HEADING = "Preferred Compound"


def response_status(status: Column, throttle_header: Column, body: Column) -> Column:
    """Class of a fetched record; the first reason that applies wins."""
    header = F.lower(F.coalesce(throttle_header, F.lit("")))
    throttled = reduce(Column.__or__, [F.contains(header, F.lit(w)) for w in THROTTLE_WORDS])
    first_of = lambda path: F.get_json_object(body, path)
    return (
        F.when(status != 200, "http_error")
        .when(throttled, "throttled")
        .when(F.contains(body, F.lit(INVALID_RECORD)), "invalid_id")
        .when(first_of("$.Fault").isNotNull(), "fault")
        .when(first_of("$.Record").isNull(), "no_record")
        .when(F.coalesce(first_of("$.Record.Section.TOCHeading[0]"), F.lit("")) != WANTED_HEADING, "wrong_heading")
        .otherwise("ok")
    )


def id_semi_join(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is listed. No hint: Spark broadcasts the list only when its size is small."""
    return df.join(ids.select(key), key, "left_semi")


def resume_anti_join(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Keys still to be fetched."""
    return wanted.join(done.select(key), key, "left_anti")


def duplicate_groups(df: DataFrame, column: str, key: str) -> DataFrame:
    """The rows whose value occurs more than once; ``key`` identifies a row."""
    repeated = df.groupBy(column).agg(F.count("*").alias("_n")).filter("_n > 1").select(column)
    return sliced_join(df, repeated, [column], [key], "left_semi")
