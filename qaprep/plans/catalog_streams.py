"""Registered queries: the running jobs. The rows are written as several files and streamed one file
per batch; what the stream leaves behind must equal the result over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaprep.operators import reactions as A
from qaprep.plans import fixtures as X
from qaprep.plans.catalog_tables import responses
from qaprep.plans.catalog_text import R, S, _PARSED
from qaprep.plans.registry import query
from qaprep.session import new_folder
from qaprep.streaming import jobs

FILES = 4


def _as_stream(spark: SparkSession, df: DataFrame, key: str) -> DataFrame:
    path = new_folder(spark, "stream")
    df.repartition(FILES, key).write.parquet(path)
    return jobs.file_stream(spark, path, df.schema, files_per_batch=1)


@query("incremental_ingest", "SELECT page_id, 'http' || substr(url, 5) AS url FROM pages WHERE page_id % 7 = 0")
def incremental_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Accepted records out of the bundles the stream packed."""
    output, checkpoint = new_folder(spark, "ingest"), new_folder(spark, "ingest-progress")
    stream = _as_stream(spark, responses(spark, folder), "page_id")
    jobs.incremental_ingest(stream, "page_id", output, checkpoint, bundle_size=8).awaitTermination()
    records = spark.read.parquet(output).select(F.inline("records"))
    return records.select("page_id", F.get_json_object("body", "$.Record.Url").alias("url"))


@query(
    "running_exact_match",
    S + """SELECT question_id, count(*) AS total, count(*) FILTER (WHERE is_match) AS correct,
      round(CAST(count(*) FILTER (WHERE is_match) AS DOUBLE) / count(*), 6) AS exact_match FROM judged GROUP BY question_id""",
)
def running_exact_match(spark: SparkSession, folder: str) -> DataFrame:
    output, checkpoint = new_folder(spark, "running"), new_folder(spark, "running-progress")
    stream = _as_stream(spark, X.predictions(spark, folder), "example_id")
    jobs.running_exact_match(stream, output, checkpoint).awaitTermination()
    return spark.read.parquet(output).withColumn("exact_match", F.round("exact_match", 6))


@query("streaming_dedup", R + f"SELECT DISTINCT reactants, agents, products FROM ({_PARSED})")
def streaming_dedup(spark: SparkSession, folder: str) -> DataFrame:
    output, checkpoint = new_folder(spark, "unique"), new_folder(spark, "unique-progress")
    lines = _as_stream(spark, X.reactions(spark, folder), "cid")
    parsed = A.parse_reactions(lines).select(*A.PARTS)
    jobs.streaming_dedup(parsed, A.PARTS, output, checkpoint).awaitTermination()
    return spark.read.parquet(output).select(*[F.array_join(name, ".").alias(name) for name in A.PARTS])
