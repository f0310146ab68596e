"""Weighted keyword search over a catalogue of titles and summaries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lorebank.operators.vector import ARROW, best_of, query_blocks

#: Points of a word by the field that holds it.
WEIGHTS = {"title_es": 15, "title_en": 10, "summary_es": 3, "summary_en": 2}
#: Queries that are broadcast at once.
QUERY_BLOCK = 1024
#: Scores (rows by queries) that a task holds at once.
CELLS = 1 << 20


def _score_task(shared, fields: list[str], k: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        ids, asked, weights = shared.value
        words = sorted({w for ws in asked for w in ws})
        place = {w: i for i, w in enumerate(words)}
        times = np.zeros((len(words), len(asked)), np.int32)  # how often a query says a word
        for q, ws in enumerate(asked):
            for w in ws:
                times[place[w], q] += 1
        automaton = ahocorasick.Automaton()
        for w, i in place.items():
            automaton.add_word(w, i)
        automaton.make_automaton()
        best: pa.RecordBatch | None = None
        step = max(1, CELLS // max(len(words), len(asked)))
        for batch in batches:
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                points = np.zeros((part.num_rows, len(words)), np.int32)
                for name, weight in zip(fields, weights):
                    for r, text in enumerate(part[name].to_pylist()):
                        there = {i for _, i in automaton.iter(text)}
                        points[r, list(there)] += weight
                scores = points @ times
                row, q = np.nonzero(scores)
                found = pa.RecordBatch.from_arrays([pa.array(q), part["id"].take(pa.array(row)), part["place"].take(pa.array(row)), pa.array(scores[row, q].astype(np.int32))], ["q", "id", "place", "score"])
                best = best_of([found] if best is None else [best, found], "score", "place", k)
        if best is not None:
            yield pa.RecordBatch.from_arrays([ids.take(best["q"]), best["id"], best["place"], best["score"]], ["query_id", "id", "place", "score"])

    return task


def keyword_search(index: DataFrame, queries: DataFrame, weights: dict[str, int] | None = None, k: int = 5, order: str = "id", block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, id, score, pos: substring tests of each lower-case word of more than two characters.

    A repeated word counts again; ties stand in input order (column ``order``, a number or a text without
    nulls). Queries are broadcast in blocks of a fixed size. Each row is read once a block: one automaton finds
    all words in a field, and each task passes on its best k of a query only.
    """
    weights = weights or WEIGHTS
    words = F.filter(F.split(F.lower("query_text"), r"\s+"), lambda w: F.length(w) > 2)
    asked = queries.select("query_id", words.alias("words")).filter(F.size("words") > 0)
    rows = index.select("id", F.col(order).alias("place"), *[F.lower(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in weights])
    kinds = {"query_id": queries.schema["query_id"].dataType.simpleString(), "id": rows.schema["id"].dataType.simpleString(), "place": rows.schema["place"].dataType.simpleString()}
    schema = ", ".join(f"{c} {t}" for c, t in kinds.items()) + ", score int"
    found = None
    for part in query_blocks(asked, block):
        ids = pa.array([r.query_id for r in part], ARROW.get(kinds["query_id"]))
        shared = rows.sparkSession.sparkContext.broadcast((ids, [r.words for r in part], list(weights.values())))
        one = rows.mapInArrow(_score_task(shared, list(weights), k), schema)
        found = one if found is None else found.unionByName(one)
    if found is None:
        found = rows.sparkSession.createDataFrame([], schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "place")
    return found.withColumn("pos", F.row_number().over(best)).filter(F.col("pos") <= k).select("query_id", "id", "score", "pos")
