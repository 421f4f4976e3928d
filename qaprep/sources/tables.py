"""Readers. Each returns a lazy DataFrame; splitting is left to Spark."""

from __future__ import annotations

from functools import reduce
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaprep.functions.text import strip
from qaprep.operators.indexing import first_rows
from qaprep.session import write_through
from qaprep.sources.arrow_files import ArrowFiles

QUESTION_FIELDS = ("question_id", "question_template", "assistant_template", "split", "metadata")


def load_table(spark: SparkSession, path: str, limit: int | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Read by suffix: .arrow, .parquet, .csv, .tsv, .jsonl or .json; optionally ``limit`` rows, those with the
    smallest hash, whatever the files and splits."""
    suffix = PurePosixPath(path).suffix.lower()
    reader = spark.read if schema is None else spark.read.schema(schema)
    if suffix == ".arrow":
        table = arrow_source(spark, path)
    elif suffix == ".parquet":
        table = reader.parquet(path)
    elif suffix in (".csv", ".tsv"):
        sep = "," if suffix == ".csv" else "\t"
        table = reader.csv(path, header=True, sep=sep, inferSchema=schema is None, quote='"', escape='"')
    elif suffix in (".jsonl", ".json"):
        table = reader.json(path)
    else:
        raise ValueError(f"unsupported input format: {suffix}")
    if limit is None:
        return table
    hashed = [F.col(f"`{f.name}`") for f in table.schema.fields if not isinstance(f.dataType, T.MapType)]
    return first_rows(table, [F.xxhash64(*hashed)], limit)


def concat_files(spark: SparkSession, paths: list[str], name: str | None = None) -> DataFrame:
    """Files of any of the formats as one table, matched by column name; ``name`` adds a column with the
    file's name without its suffix."""
    if not paths:
        raise ValueError("no files to concatenate")
    parts = []
    for path in paths:
        table = load_table(spark, path)
        parts.append(table if name is None else table.withColumn(name, F.lit(PurePosixPath(path).stem)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def arrow_source(spark: SparkSession, path: str, batches_per_split: int = 64) -> DataFrame:
    """Arrow IPC files; a split is a run of record batches."""
    spark.dataSource.register(ArrowFiles)
    return spark.read.format("arrow_files").option("batches_per_split", batches_per_split).load(path)


def reaction_lines(spark: SparkSession, path: str, skip_header: bool = True) -> DataFrame:
    """Non-blank lines as ``value``; the first line of each file is a header."""
    lines = spark.read.schema("value string").csv(path, header=skip_header, sep="\u0001", quote="")
    return lines.filter(strip(F.col("value")) != "")


def id_list(spark: SparkSession, path: str, name: str = "cid") -> DataFrame:
    """Distinct integer ids, one per line; blank lines are ignored."""
    lines = spark.read.text(path).select(strip(F.col("value")).alias("value")).filter("value != ''")
    return lines.select(F.col("value").cast("bigint").alias(name)).distinct()


def headerless_tsv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).csv(path, sep="\t", header=False, quote='"', escape='"')


def questions_source(spark: SparkSession, path: str, metadata: T.StructType | None = None) -> DataFrame:
    """Question records. With the metadata schema given, no pass is spent on inference."""
    if metadata is None:
        return spark.read.json(path)
    fields = [T.StructField(n, T.StringType()) for n in QUESTION_FIELDS[:-1]]
    return spark.read.schema(T.StructType([*fields, T.StructField("metadata", metadata)])).json(path)


def tokenised_source(spark: SparkSession, path: str, split: str = "test") -> DataFrame:
    """One split of a saved dataset; ``val`` means ``valid``. Other splits are not read."""
    wanted = "valid" if split == "val" else split
    table = spark.read.parquet(path).filter(F.col("split") == wanted)
    if table.isEmpty():
        raise ValueError(f"split '{split}' not found in {path}")
    return table


def summary_bundles(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Files that each hold a JSON array of records, gzipped or not; one row per record."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("multiLine", True).option("recursiveFileLookup", True).json(path)


def per_file_cap(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of each input file, in file order.

    ``df`` must come straight from a file scan. Rows are cut inside each file block first; the
    blocks before a block then tell how many of its rows are still wanted. No window spans a file.
    """
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seen"),
    )
    rank = F.row_number().over(Window.partitionBy("_file", "_block").orderBy("_seen"))
    cut = write_through(placed.withColumn("_rank", rank).filter(F.col("_rank") <= n), "capped")
    blocks = cut.groupBy("_file", "_block").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    kept = cut.join(starts, ["_file", "_block"]).filter(F.col("_before") + F.col("_rank") <= n)
    return kept.select(*df.columns)
