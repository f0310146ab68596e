"""Embeddings that are asked for once: a ledger by the hash of the text, written part by part.

A run asks the embedder only for texts of which the ledger has no vector. Each part is written before the next is
begun, so a run that fails keeps all but the part it was in, and the next run asks for the rest only. Equal texts
are one text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorebank.sources.io import embed

_LEDGER = "text_sha string, embedding array<float>"


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """text_sha, embedding: all that was ever embedded here."""
    try:
        return spark.read.schema(_LEDGER).parquet(f"{root}/vectors")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LEDGER)


def embed_missing(df: DataFrame, text_col: str, root: str, embedder: Callable[[list[str]], list[list[float]]], parts: int = 16, batch: int = 100, tries: int = 4, wait: float = 1.0) -> int:
    """Asks for the vectors that the ledger lacks, a part of the texts (by hash) after the other; how many these were.

    ``parts``: more of them lose less when the embedder fails, at a job each. Null texts count as empty."""
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    wanted = df.select(F.sha2(text, 256).alias("text_sha"), text.alias("text"))
    missing = wanted.join(ledger(spark, root).select("text_sha"), "text_sha", "left_anti").dropDuplicates(["text_sha"])
    work = f"{root}/missing"
    missing.withColumn("part", F.pmod(F.xxhash64("text_sha"), F.lit(parts)).cast("int")).write.mode("overwrite").partitionBy("part").parquet(work)
    todo = spark.read.schema("text_sha string, text string, part int").parquet(work)
    sizes = {r.part: r["count"] for r in todo.groupBy("part").count().collect()}  # a row a part
    for part in sorted(sizes):
        rows = todo.filter(F.col("part") == part).select("text_sha", "text")
        embed(rows, "text", embedder, batch, tries, wait).select("text_sha", "embedding").write.mode("append").parquet(f"{root}/vectors")
    return sum(sizes.values())


def with_embeddings(df: DataFrame, text_col: str, root: str) -> DataFrame:
    """df with ``embedding`` from the ledger; null for texts that it lacks."""
    known = ledger(df.sparkSession, root).dropDuplicates(["text_sha"]).withColumnRenamed("text_sha", "_sha")
    met = df.withColumn("_own", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).join(known, F.col("_own") == F.col("_sha"), "left")
    return met.drop("_own", "_sha")
