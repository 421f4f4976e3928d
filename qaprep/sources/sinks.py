"""Writers. Every one is a distributed Spark write."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from qaprep.operators.indexing import global_index
from qaprep.session import write_through
from qaprep.sources.arrow_files import ArrowFiles
from qaprep.sources.sdf import SQL_PROPERTIES

MINIMAL_COLUMNS = ("input_ids", "attention_mask", "labels", "position_weights")
EVAL_COLUMNS = ("input_ids", "attention_mask", "labels")


def write_questions(df: DataFrame, path: str) -> int:
    """One JSON object per line, nulls written out. The count comes from the write itself."""
    seen = Observation("questions")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.option("ignoreNullFields", "false").json(path)
    return seen.get["n"]


def minimal_columns(df: DataFrame) -> DataFrame:
    """What training needs: arrays only, next to the split."""
    return df.select("split", *[c for c in MINIMAL_COLUMNS if c in df.columns])


def write_dataset(train: DataFrame, evaluation: DataFrame, path: str) -> None:
    """``full``: valid and test with every column. ``minimal``: all splits, arrays only."""
    evaluation.write.partitionBy("split").parquet(f"{path}/full")
    # the slim rows come from what was just written: the records are worked through once
    slim = evaluation.sparkSession.read.schema(evaluation.schema).parquet(f"{path}/full").select("split", *EVAL_COLUMNS)
    both = minimal_columns(train).unionByName(slim, allowMissingColumns=True)
    both.write.partitionBy("split").parquet(f"{path}/minimal")


def write_arrow(df: DataFrame, path: str, stream: bool = False) -> None:
    """Arrow IPC, one file per task, as random-access files or as streams."""
    df.sparkSession.dataSource.register(ArrowFiles)
    kind = "stream" if stream else "file"
    df.write.format("arrow_files").option("ipc", kind).mode("append").save(path)


def write_predictions(df: DataFrame, path: str, order: str = "example_id") -> None:
    """CSV index, gold_label, prediction in the order of ``order``; quotes double, line breaks stay inside quotes.

    The rows are range-sorted once. The number of a partition is the number of its file, so what comes back from the
    written table goes to the file of its partition as it is, and is not sorted over all rows again."""
    placed = write_through(df.select(order, "gold", "prediction").orderBy(order).withColumn("_place", F.monotonically_increasing_id()), "predictions")
    placed = placed.withColumn("_part", F.shiftright("_place", 33).cast("int"))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = write_through(sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base")), "offsets")  # a row per partition
    parts = (offsets.agg(F.max("_part")).first()[0] or 0) + 1
    rows = placed.join(F.broadcast(offsets), "_part").withColumn("index", F.col("_base") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)))
    rows = rows.repartitionById(parts, "_part").sortWithinPartitions("index").select("index", F.col("gold").alias("gold_label"), "prediction")
    rows.write.csv(path, header=True, quote='"', escape='"', quoteAll=False, emptyValue="",
                   ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def column_types(properties: Mapping[str, tuple[str, str]] = SQL_PROPERTIES) -> str:
    return ", ".join(f"{column} {kind}" for column, kind in properties.values())


def write_sql(df: DataFrame, url: str, table: str, options: Mapping[str, str], partitions: int = 16) -> None:
    """Create the table and insert over a bounded number of connections."""
    wanted = {column: kind for column, kind in SQL_PROPERTIES.values()}
    types = ", ".join(f"{c} {wanted[c]}" for c in df.columns if c in wanted)
    writer = df.repartition(partitions).write.format("jdbc").option("url", url).option("dbtable", table)
    writer.option("createTableColumnTypes", types).options(**options).mode("append").save()


def write_picks(df: DataFrame, key: str, path: str) -> None:
    df.select(F.col(key).cast("string")).write.text(path)


def pack_bundles(df: DataFrame, key: str, size: int, columns: Sequence[str]) -> DataFrame:
    """Records in key order packed by ``size``: (bundle_name, first, last, n_records, records).
    A bundle is bounded by ``size``; its number comes from the global row number."""
    numbered = global_index(df.select(key, *columns), [key], "_no")
    grouped = numbered.groupBy(F.floor(F.col("_no") / size).alias("bundle")).agg(
        F.min(key).alias("first_id"),
        F.max(key).alias("last_id"),
        F.count("*").alias("n_records"),
        F.array_sort(F.collect_list(F.struct(key, *columns))).alias("records"),
    )
    name = F.concat_ws("_", F.lit("summaries"), "first_id", "last_id")
    return grouped.withColumn("bundle_name", name)


def write_bundles(bundles: DataFrame, path: str) -> None:
    """One gzipped JSON array per bundle, in a folder named after its first and last id."""
    text = bundles.select("bundle_name", F.to_json("records", {"ignoreNullFields": "false"}).alias("value"))
    text.write.partitionBy("bundle_name").option("compression", "gzip").text(path)
