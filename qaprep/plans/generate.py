"""From a table to question records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaprep.functions.templates import QuestionConfig, Template, render, template_fields
from qaprep.operators.filters import drop_null_columns, range_filter
from qaprep.plans.question_sets import question_set
from qaprep.sources.sinks import write_questions
from qaprep.sources.tables import load_table


def check_fields(df: DataFrame, templates: Sequence[Template]) -> None:
    """Every field a template names must be a column; found out before anything runs."""
    needed = {f for t in templates for f in template_fields(t.user_template) + template_fields(t.assistant_template)}
    missing = sorted(needed - set(df.columns))
    if missing:
        raise KeyError(", ".join(missing))


def expand_templates(df: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """Every row with every template, unrendered. The templates are literals of the plan, so the
    expansion is a narrow step: nothing is joined."""
    items = F.array(
        *[
            F.struct(
                F.lit(t.id).alias("question_id"),
                F.lit(t.user_template).alias("question_template"),
                F.lit(t.assistant_template).alias("assistant_template"),
            )
            for t in templates
        ]
    )
    split = F.col("split") if "split" in df.columns else F.lit("train")
    metadata = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != "split"])
    return df.select(F.inline(items), split.alias("split"), metadata.alias("metadata"))


def rendered_questions(df: DataFrame, templates: Sequence[Template], keep: Sequence[str] = ()) -> DataFrame:
    """Every row with every template, rendered: (keep..., question_id, question, answer)."""
    check_fields(df, templates)
    items = F.array(
        *[
            F.struct(
                F.lit(t.id).alias("question_id"),
                render(t.user_template, df.schema).alias("question"),
                render(t.assistant_template, df.schema).alias("answer"),
            )
            for t in templates
        ]
    )
    return df.select(*keep, F.inline(items))


def generate_questions(
    table: DataFrame,
    config: QuestionConfig,
    filter_column: str = "num_atoms",
    low: float | None = None,
    high: float | None = None,
    keep_null_columns: bool = True,
) -> DataFrame:
    """Filter, answer, expand."""
    if not keep_null_columns:
        table = drop_null_columns(table)
    answered = table.transform(lambda t: range_filter(t, filter_column, low, high)).transform(question_set(config.question_set))
    check_fields(answered, config.templates)
    return expand_templates(answered, config.templates)


def generate_file(
    spark: SparkSession, source: str, config: QuestionConfig, output: str, limit: int | None = None, **options
) -> int:
    """The whole path from a file to question records; returns how many were written."""
    return write_questions(generate_questions(load_table(spark, source, limit), config, **options), output)
