"""The running jobs as Structured Streaming queries. State and progress live in the checkpoint, so a
killed job goes on where it stopped, without loss and without duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from qaprep.operators.evaluation import with_match
from qaprep.operators.filters import response_status
from qaprep.sources.sinks import pack_bundles


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, kind: str = "parquet", name: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New files of a folder as a stream; ``name`` keeps only files of that name pattern."""
    reader = spark.readStream.schema(schema).format(kind)
    if name is not None:
        reader = reader.option("pathGlobFilter", name)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def incremental_ingest(
    responses: DataFrame, key: str, output: str, checkpoint: str, bundle_size: int = 1000,
    status: str = "status", header: str = "header", body: str = "body",
) -> StreamingQuery:
    """Classify fetched records, keep the accepted ones, pack them into bundles.

    A batch overwrites its own folder, so a batch that runs again after a failure leaves one copy.
    """
    state = response_status(F.col(status), F.col(header), F.col(body))
    accepted = responses.withColumn("_state", state).filter("_state = 'ok'").drop("_state")

    def store(batch: DataFrame, number: int) -> None:
        bundles = pack_bundles(batch, key, bundle_size, [body])
        bundles.drop("bundle").write.mode("overwrite").parquet(f"{output}/batch={number}")

    return (
        accepted.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def running_exact_match(
    scored: DataFrame, output: str, checkpoint: str, question: str = "question_id", **columns: str
) -> StreamingQuery:
    """Totals per question, kept up to date; each batch replaces the written table."""
    totals = (
        with_match(scored, **columns)
        .groupBy(question)
        .agg(F.count("*").alias("total"), F.count_if("is_match").alias("correct"))
    )
    totals = totals.withColumn("exact_match", F.try_divide(F.col("correct").cast("double"), F.col("total")))

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(output)

    return (
        totals.writeStream.outputMode("complete")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def streaming_dedup(
    rows: DataFrame, columns: Sequence[str], output: str, checkpoint: str, event_time: str | None = None, delay: str = "1 hour",
) -> StreamingQuery:
    """The first row of each combination. The state holds every combination seen; with an event
    time it is bounded by the watermark instead."""
    if event_time is None:
        unique = rows.dropDuplicates(list(columns))
    else:
        unique = rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(columns))
    return (
        unique.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", output)
        .trigger(availableNow=True)
        .start()
    )
