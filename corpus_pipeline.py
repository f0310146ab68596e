"""A corpus pipeline: quality, exact and near duplicates, benchmark passages, token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but the last return
the columns of documents, whichever these are. A stage on an empty table returns an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lorebank.llm import bpe_codec, decontaminate, exact_dedup, near_dedup, quality
from lorebank.llm.common import table
from lorebank.llm.scratch import checkpointed


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier draws."""
    return quality.select_documents(docs, table(spark, sf_dir, "labels"))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    return exact_dedup.exact_dedup(docs)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates the document with the smallest doc_id."""
    return near_dedup.near_dedup(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return bpe_codec.coded(docs)


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", keep_distinct),
    ("near_dedup", keep_one_of_near),
    ("decontaminate", keep_uncontaminated),
    ("bpe", encode),
]

#: Learned weights, sketches and BPE merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
