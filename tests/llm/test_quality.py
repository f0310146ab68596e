import random

import pytest
from pyspark.sql import functions as F

from lorebank.llm import quality
from tests.llm.helpers import SCHEMA, clashing, frame, prose, rows

LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    good = [(i, prose(rng, rng.randint(20, 80)), "en", "s", 0) for i in range(150)]
    bad = [(200 + i, " ".join(w + "###" for w in prose(rng, 40).split()), "en", "s", 0) for i in range(30)]
    bad += [(300 + i, " ".join([prose(rng, 1)] * 40), "en", "s", 0) for i in range(30)]
    docs = good + bad
    labels = [(d, int(d < 200), 0) for d, *_ in docs if d % 2 == 0] + [(None, 1, None), (4, None, None)]
    return docs, labels


def test_keeps_good_and_drops_bad(spark, corpus):
    docs, labels = corpus
    out = {r.doc_id: r.kept for r in quality.selected(frame(spark, docs), frame(spark, labels, LABELS)).collect()}
    assert all(out[d] for d in out if d < 200)
    assert sum(out[d] for d in out if d >= 200) <= 1


def test_selection_is_the_exact_top_k(spark, corpus):
    docs, labels = corpus
    out = quality.selected(frame(spark, docs), frame(spark, labels, LABELS)).collect()
    k = sum(r.kept for r in out)
    assert {r.doc_id for r in sorted(out, key=lambda r: -r.key)[:k]} == {r.doc_id for r in out if r.kept}


def test_stage_agrees_with_scores_and_keeps_columns(spark, corpus):
    docs, labels = corpus
    df, marks = clashing(frame(spark, docs)), frame(spark, labels, LABELS)
    kept = quality.select_documents(df, marks)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality.selected(df, marks).filter("kept").collect()}


def test_weights_match_a_plain_count(spark, corpus):
    import numpy as np
    import pyarrow as pa

    from lorebank.llm.common import buffers

    texts = ["Ab ab, cd!!", "x x x", "", "é-é"]
    bucket, text = quality.features(*buffers(pa.array(texts)))
    assert np.bincount(text, minlength=4).tolist() == [9, 5, 0, 5]  # 5 tokens and 4 pairs; 3 and 2; none; 3 and 2
    assert len(set(bucket[text == 1].tolist())) == 2  # x, and x said twice


def test_odd_rows_and_empty_tables(spark):
    df, none = frame(spark, rows()), frame(spark, [], LABELS, 1)
    out = quality.selected(df, none).collect()
    assert len(out) == len(rows()) and all(r.kept for r in out)
    assert quality.selected(frame(spark, [], SCHEMA, 1), frame(spark, [(1, 1, 0)], LABELS)).count() == 0


@pytest.mark.parametrize("k", [1, 2, 50, 199, 200])
def test_kth_largest(spark, k):
    rng = random.Random(k)
    values = [rng.choice([rng.gauss(0, 1), 3.0, -1e6]) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    assert quality.kth_largest(df, "x", k, width=7) == sorted(values, reverse=True)[k - 1]
    assert df.filter(F.col("x") >= quality.kth_largest(df, "x", k)).count() >= k


def test_null_ids(spark, corpus):
    docs, labels = corpus
    some = [(None, docs[0][1], "en", "s", 0), (None, docs[-1][1], "en", "s", 0), (None, None, None, None, None)]
    df, marks = frame(spark, docs + some), frame(spark, labels, LABELS)
    out = quality.selected(df, marks).filter("doc_id is null").collect()
    assert len(out) == 3 and sorted(r.log_weight for r in out)[0] < 0
    kept = quality.select_documents(df, marks).filter("doc_id is null").collect()
    assert len(kept) == sum(r.kept for r in out) < 3
