"""From a tokenised split and a predictions table to metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaprep.functions.tokens import decode_ids, sanitize_ids
from qaprep.operators.evaluation import accuracy_by_question, accuracy_summary, align_predictions, exact_match, with_match
from qaprep.operators.sampling import seeded_sample
from qaprep.sources.sinks import write_predictions
from qaprep.sources.tables import tokenised_source


def evaluate(
    spark: SparkSession,
    dataset: str,
    predictions: DataFrame,
    split: str = "test",
    key: str = "example_id",
    limit: int | None = None,
    csv_path: str | None = None,
) -> dict[str, DataFrame]:
    """Score predictions (key, prediction) against one split of a saved dataset."""
    gold = tokenised_source(spark, dataset, split)
    if limit is not None:
        gold = seeded_sample(gold, key, limit)
    texts = gold.select(key, "question_id", decode_ids(sanitize_ids(F.col("labels"))).alias("gold"))
    aligned = align_predictions(texts, predictions.select(key, "prediction"), key)
    if csv_path is not None:
        write_predictions(aligned, csv_path, key)
    return {
        "exact_match": exact_match(with_match(aligned)),
        "by_question": accuracy_by_question(aligned),
        "summary": accuracy_summary(aligned),
    }
