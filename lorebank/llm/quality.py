"""Quality classifier by importance resampling of hashed n-grams.

A generative model of target text (documents labelled good) and one of raw text (all documents) are
distributions over hashed buckets of single tokens and pairs of tokens; tokens are runs of word characters
and runs of other solid characters. The log weight of a document is the sum, over its n-grams, of the
logarithm of the ratio of both probabilities. Documents are drawn in proportion to their weights, without
replacement, by Gumbel top-k: standard Gumbel noise is added to each log weight and the k largest stay.

k is not a fixed number: it is the count of all documents whose weight reaches a threshold, and that is
calibrated on labelled documents (the one with the least cost, of equal ones the lowest; to lose a good
document costs as much as to keep ``LOSS`` bad ones). The target model
and the threshold use a bounded sample of labelled rows (``MAX_LABELLED`` ids, by hash); the raw model, the
weights and k cover all documents. Noise is a function of doc_id, so a repeated task draws the same.

Null and empty texts have weight 0. Without good labels the target model is the raw one: all weights are
0 and every document stays; so does every document where no label is bad. Labels that are null are ignored;
repeated labels count once, the lowest holds. Repeated rows of documents get the same weight and noise; rows
of null doc_id have no label, and noise in common.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lorebank.llm.common import SOLID_BYTES, WORD_BYTES, Words, blocks, buffers, mixed, table, text_of
from lorebank.llm.scratch import checkpointed

BUCKETS = 1 << 14
MAX_LABELLED = 20_000
SEED = 11
LOSS = 5
#: Counts added to every bucket.
SMOOTHING = 1.0

_MARK_BYTES = SOLID_BYTES & ~WORD_BYTES


#: A token said twice is one n-gram, whatever the token.
_TWICE = np.uint64(1)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every n-gram of one or two tokens."""
    kinds = [Words(data, offsets, mask, lower=False) for mask in (WORD_BYTES, _MARK_BYTES)]
    start = np.concatenate([w.start for w in kinds])
    order = np.argsort(start, kind="stable")
    h = np.concatenate([w.hash for w in kinds])[order]
    text = np.concatenate([w.owner() for w in kinds])[order]
    same = text[1:] == text[:-1]
    pair = np.where(h[1:] == h[:-1], _TWICE, mixed(h[:-1] * np.uint64(3) + h[1:]))[same] if len(h) > 1 else h[:0]
    buckets = (np.concatenate([h, pair]) % np.uint64(BUCKETS)).astype(np.int64)
    return buckets, np.concatenate([text, text[:-1][same] if len(h) > 1 else text[:0]])


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of all rows and of good ones, a row for each bucket that has any."""
    total = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        data, offsets = buffers(batch["text"])
        good = batch["good"].to_numpy(zero_copy_only=False)
        for a, b in blocks(offsets):
            bucket, text = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            total[0] += np.bincount(bucket, minlength=BUCKETS)
            total[1] += np.bincount(bucket[good[a:b][text]], minlength=BUCKETS)
    some = np.flatnonzero(total[0])
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0, some]), pa.array(total[1, some])], ["bucket", "raw", "target"])


def weight_udf(ratio: np.ndarray, spark: SparkSession):
    """Text to log weight. The ratios are one number a bucket: their size is fixed."""
    shared = spark.sparkContext.broadcast(ratio)

    @F.arrow_udf(T.DoubleType())
    def weight(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ratio = shared.value
        for texts in batches:
            data, offsets = buffers(texts)
            out = np.zeros(len(texts))
            for a, b in blocks(offsets):
                bucket, text = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                out[a:b] = np.bincount(text, weights=ratio[bucket], minlength=b - a)
            yield pa.array(np.round(out, 6))

    return weight


def labelled_sample(labels: DataFrame, column: str = "quality", limit: int = MAX_LABELLED) -> dict[int, int]:
    """At most ``limit`` labelled ids, chosen by hash, with their labels."""
    rows = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(column).cast("int").alias("label")).dropna()
    one = rows.groupBy("doc_id").agg(F.min("label").alias("label"))
    return {r.doc_id: r.label for r in one.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(limit).collect()}


def gumbel(doc_id: str = "doc_id") -> Column:
    """Standard Gumbel noise of a row."""
    u = (F.pmod(F.xxhash64(F.lit(SEED), F.lit("gumbel"), F.col(doc_id)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def kth_largest(rows: DataFrame, column: str, k: int, width: int = 4096) -> float:
    """The exact k-th largest value. Each pass counts ``width`` intervals; the one that holds it is split again."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    left = k
    while low < high:
        step = (high - low) / width
        if low + step == low:
            break
        cell = F.least(F.floor((F.col(column) - low) / step), F.lit(width - 1))
        inside = rows.filter(F.col(column).between(low, high))
        found = sorted(inside.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("a"), F.max(column).alias("b")).collect(), key=lambda r: -r.cell)
        for r in found:
            if left <= r.n:
                low, high = r.a, r.b
                break
            left -= r.n
    return high


class Selection:
    """A fitted classifier: the weight function, and the least key (weight and noise) that stays."""

    def __init__(self, spark: SparkSession, ratio: np.ndarray, least: float):
        self.spark, self.ratio, self.least = spark, ratio, least

    def weight(self, text: Column) -> Column:
        return weight_udf(self.ratio, self.spark)(text)


def threshold(weights: list[tuple[float, int]]) -> float:
    """The weight from which on documents count as good: least labelled cost, the lowest of equal ones."""
    good = np.sort([w for w, label in weights if label == 1])
    bad = np.sort([w for w, label in weights if label == 0])
    if not len(good) or not len(bad):
        return -np.inf
    at = np.unique(np.concatenate([[-np.inf], good, bad]))
    errors = LOSS * np.searchsorted(good, at, side="left") + len(bad) - np.searchsorted(bad, at, side="left")
    best = int(np.argmin(errors))
    below = at[best - 1] if best else -np.inf
    return float((at[best] + below) / 2) if np.isfinite(below) else float(at[best])


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Selection, DataFrame]:
    """The classifier, and all documents as doc_id, log_weight, key."""
    spark = docs.sparkSession
    sample = labelled_sample(labels)
    good = [i for i, label in sample.items() if label == 1]
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of("text").alias("text"))
    # The sample has at most MAX_LABELLED ids, so it may be broadcast.
    chosen = F.broadcast(spark.createDataFrame(list(sample.items()), "id bigint, label int"))
    marked = texts.join(chosen, F.col("doc_id") == F.col("id"), "left").select("doc_id", "text", "label")
    counts = marked.select("text", F.coalesce(F.col("label") == 1, F.lit(False)).alias("good")).mapInArrow(_count_task, "bucket bigint, raw bigint, target bigint")
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    if not good or not target.sum():
        target = raw
    share = lambda x: (x + SMOOTHING) / (x + SMOOTHING).sum()
    ratio = np.log(share(target)) - np.log(share(raw))
    weighed = marked.select("doc_id", "label", weight_udf(ratio, spark)("text").alias("log_weight")).withColumn("key", F.col("log_weight") + gumbel())
    weighed = checkpointed(weighed)  # three numbers and a label a document
    # Rows of at most MAX_LABELLED ids; where ids repeat, each id and label counts with its least weight.
    calibration = weighed.filter("label is not null").groupBy("doc_id", "label").agg(F.min("log_weight").alias("log_weight"))
    cut = threshold([(r.log_weight, r.label) for r in calibration.collect()])
    k = weighed.filter(F.col("log_weight") >= F.lit(cut)).count()
    least = kth_largest(weighed, "key", k) if k and np.isfinite(cut) else -np.inf
    return Selection(spark, ratio, least), weighed


def selected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, log_weight, key, kept."""
    model, weighed = fit(docs, labels)
    return weighed.select("doc_id", "log_weight", "key", (F.col("key") >= F.lit(model.least)).alias("kept"))


def select_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns: weighed again while they are read, without a shuffle."""
    model, _ = fit(docs, labels)
    return docs.filter(model.weight(text_of("text")) + gumbel() >= F.lit(model.least))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selected(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
