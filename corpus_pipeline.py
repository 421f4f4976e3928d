"""The corpus pipeline: stages over the documents table, each written and read again.

Every stage works on all rows its predecessor kept. Null and empty texts are documents like any other:
they are not toxic, equal one another, have no near copies and lose no passage. An empty table stays
empty. All stages but the last return the columns of ``documents``, whatever they are beside ``doc_id``
and ``text``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaprep.llm import toxicity as toxic
from qaprep.llm.common import session, table
from qaprep.llm.exact_dedup import drop_exact_duplicates
from qaprep.llm.minhash import drop_near_duplicates
from qaprep.llm.packing import pack
from qaprep.llm.queries import vocabulary
from qaprep.llm.suffix_dedup import cut_repeats
from qaprep.session import write_through


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the model learns from the labelled documents among ``docs``."""
    model = toxic.train(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return toxic.drop_toxic(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the one with the largest id stays."""
    session(spark)
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest id stays."""
    session(spark)
    return drop_near_duplicates(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes or more that also start earlier are cut out of the texts."""
    session(spark)
    return cut_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences: doc_id, start, length, doc_tokens, sequence_id, offset, ids."""
    session(spark)
    return pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("suffix-array dedup", passage_dedup),
    ("packing", packing),
]
#: SQL can express neither the classifier nor the tokenizer; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = write_through(docs, f"stage-{number}")
    return docs
