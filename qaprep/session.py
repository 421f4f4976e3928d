"""Session settings and the shared staging folder.

Everything that has to be computed once and read many times (global row numbers, rounds of an
iterative job) is written as a parquet table into the folder named by ``spark.checkpoint.dir``.
A written table cuts the lineage, is columnar, and outlives any executor.
"""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # a batch becomes arrays several times its size in a Python worker
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Set the session options the operators count on; none is specific to a data size."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    # the few Python helpers travel with the plan, so executors need no installed package
    cloudpickle.register_pickle_by_value(sys.modules["qaprep"])
    return spark


def staging_folder(spark: SparkSession) -> str:
    """The shared folder of the cluster; a private one only on a local master without a setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="qaprep-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder name in the staging folder that nothing else uses."""
    return f"{staging_folder(spark)}/qaprep/{label}-{uuid.uuid4().hex}"


def write_through(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and go on from the written table. The shuffle files behind it are dropped with the end of
    the write: its plan is its own, so nothing else reads them, and they need not wait for the driver's next
    garbage collection."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before) if before is not None else spark.conf.unset(SHUFFLE_CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give a scan that has fewer splits than there are cores a split per core, ahead of heavy work
    per row: a compressed file, or a table of a few files. A table with more splits stays as it is,
    so nothing is shuffled at scale. For plain scans only: splits of a plan with shuffles are not
    known ahead."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
