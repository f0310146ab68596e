import random

import pytest

from lorebank.llm import toxicity as t
from tests.llm.helpers import SCHEMA, clashing, frame, prose, rows

LABELS = "doc_id bigint, quality int, toxic int"
BAD = ["idiot", "worthless", "scum", "pathetic", "moron"]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(500):
        w = prose(rng, rng.randint(15, 120)).split()
        toxic = i % 4 == 0
        for _ in range(3 * toxic):
            w.insert(rng.randrange(len(w)), rng.choice(BAD))
        docs.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark, corpus):
    docs, labels = corpus
    learn = [r for r in labels if r[0] % 5] + [(None, 1, 1), (3, 1, None), (1, 1, 0)]
    out = {r.doc_id: r for r in t.scored(clashing(frame(spark, docs)), frame(spark, learn, LABELS)).collect()}
    held = [(r[2], out[r[0]]) for r in labels if r[0] % 5 == 0]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out.values())
    assert sum(y == r.predicted for y, r in held) >= 0.93 * len(held)


def test_scores_do_not_depend_on_partitions(spark, corpus):
    docs, labels = corpus
    marks = frame(spark, labels, LABELS)
    a, b = ({r.doc_id: r.score for r in t.scored(frame(spark, docs + [(10_000 + (d or 0), *r) for d, *r in rows()], parts=n), marks).collect()} for n in (1, 7))
    assert a == b


def test_without_labels_and_empty_tables(spark):
    none = frame(spark, [], LABELS, 1)
    assert {(r.score, r.predicted) for r in t.scored(frame(spark, rows()), none).collect()} == {(0.0, 0)}
    assert {r.predicted for r in t.scored(frame(spark, rows()), frame(spark, [(1, 1, 1), (2, 1, 1)], LABELS)).collect()} == {1}
    assert t.scored(frame(spark, [], SCHEMA, 1), frame(spark, [(1, 1, 0)], LABELS)).count() == 0


def test_bounds_are_compared_by_folds_of_labelled_rows(corpus):
    docs, labels = corpus
    sample = [(d, x, y) for (d, x, *_), (_, _, y) in zip(docs, labels)]
    areas = t.compared_bounds(sample, (2_000, 1 << 20))
    assert 0.9 < areas[1 << 20] <= 1 and areas[2_000] < areas[1 << 20]
    assert t._fitting(sample, 0) == [] and {r[0] for r in t._fitting(sample, 1 << 30)} == {r[0] for r in sample}
