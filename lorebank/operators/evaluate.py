"""Retrieval evaluation: first hits, recall, reciprocal rank, precision, comparison of runs."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def judge(golden: DataFrame, retrieved: DataFrame) -> DataFrame:
    """One row a question: hit (null where nothing is expected), rank of the first relevant result, top score.

    golden: query_id, type, expected (array), and the question if it shall be kept. retrieved: query_id, pos, episode, similarity. Positions count
    results with an episode only; the top score is the first result's similarity, with an episode or not."""
    top = retrieved.groupBy("query_id").agg(F.min_by("similarity", "pos").alias("top_score"))
    seen = retrieved.filter("episode is not null").withColumn("at", F.row_number().over(Window.partitionBy("query_id").orderBy("pos")))
    asked = golden.select("query_id", "expected")
    first = seen.join(asked, "query_id").filter(F.array_contains("expected", F.col("episode"))).groupBy("query_id").agg(F.min("at").alias("rank"))
    out = golden.join(top, "query_id", "left").join(first, "query_id", "left")
    judged = (F.col("type") != "offtopic") & (F.size("expected") > 0)
    return out.select("query_id", "type", *[c for c in ("question",) if c in golden.columns], F.when(judged, F.col("rank").isNotNull()).alias("hit"), F.when(judged, F.col("rank")).alias("rank"), F.coalesce("top_score", F.lit(0.0)).alias("top_score"), (F.size("expected") > 0).alias("answerable"))


def _measures(exclude_unanswerable: bool):
    counted = (F.col("type") != "offtopic") & (F.col("answerable") if exclude_unanswerable else F.lit(True))
    n = F.count_if(counted)
    hits = F.count_if(F.coalesce("hit", F.lit(False)))
    return [
        n.alias("evaluable"), hits.alias("hits"), F.round(F.coalesce(F.try_divide(hits, n), F.lit(0.0)), 3).alias("recall"),
        # Rounded first to what does not depend on the order of the sum.
        F.round(F.round(F.coalesce(F.try_divide(F.sum(F.when(F.col("hit"), 1.0 / F.col("rank")).otherwise(0.0)), n), F.lit(0.0)), 9), 3).alias("mrr"),
        F.round(F.avg(F.when(F.col("type") == "offtopic", F.col("top_score"))), 3).alias("offtopic_score"),
    ]


def eval_summary(judged: DataFrame, exclude_unanswerable: bool = False) -> DataFrame:
    """Evaluable questions, hits, recall, mean reciprocal rank, mean top score of off-topic questions."""
    return judged.agg(*_measures(exclude_unanswerable))


def eval_by_type(judged: DataFrame) -> DataFrame:
    """The same by type, and for all (type ``all``)."""
    return judged.rollup("type").agg(*_measures(False)).withColumn("type", F.coalesce("type", F.lit("all")))


def rank_histogram(judged: DataFrame) -> DataFrame:
    return judged.filter("hit").groupBy("rank").agg(F.count(F.lit(1)).alias("questions"))


def context_precision(retrieved: DataFrame, flags: DataFrame, k: int) -> DataFrame:
    """Share of the k slots of a query that are useful: filled, and not flagged. flags: id, is_ad."""
    own = retrieved.filter(F.col("pos") <= k).join(flags.select("id", "is_ad"), "id", "left")
    return own.groupBy("query_id").agg((F.count_if(~F.coalesce("is_ad", F.lit(False))) / F.lit(float(k))).alias("precision"))


@F.arrow_udf(T.LongType())
def _held(keywords: pa.Array, contexts: pa.Array) -> pa.Array:
    """How many keywords, repeats too, a context holds: one pass of an automaton of the distinct ones."""
    import ahocorasick

    out = []
    for words, context in zip(keywords.to_pylist(), contexts.to_pylist()):
        if words is None:
            out.append(None)
            continue
        times = Counter(w for w in words if w is not None)
        always = times.pop("", 0)
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for w in times:
            automaton.add_word(w, w)
        automaton.make_automaton()
        met = {w for _, w in automaton.iter(context)} if times and context else ()
        out.append(always + sum(times[w] for w in met))
    return pa.array(out, pa.int64())


def keyword_coverage(expected: DataFrame, context: DataFrame) -> DataFrame:
    """Share of a question's expected keywords that its context holds. expected: query_id, keywords.

    Null keywords are expected and never found; an empty one always is."""
    met = expected.join(context, "query_id", "left")
    found = _held(F.transform("keywords", lambda w: F.lower(w)), F.lower(F.coalesce(F.col("context"), F.lit(""))))
    counted = met.select("query_id", found.alias("found"), F.size("keywords").cast("long").alias("expected"))
    return counted.select("query_id", "found", "expected", F.try_divide("found", "expected").alias("share"))


def diff_runs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Places at which two runs differ. a, b: query_id, pos, id."""
    left, right = a.select("query_id", "pos", F.col("id").alias("id_a")), b.select("query_id", "pos", F.col("id").alias("id_b"))
    return left.join(right, ["query_id", "pos"], "full").filter(~F.col("id_a").eqNullSafe(F.col("id_b")))


def same_runs(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: rows of either run that the other lacks, and rows of both."""
    cols = ["query_id", "pos", "id"]
    x, y = a.select(cols), b.select(cols)
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return one(x.exceptAll(y), "only_a").crossJoin(one(y.exceptAll(x), "only_b")).crossJoin(one(x.intersect(y), "both"))  # three single rows
