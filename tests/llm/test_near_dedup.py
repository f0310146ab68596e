import random

import pytest

from lorebank.llm import near_dedup as n
from lorebank.llm.components import components
from tests.llm.helpers import SCHEMA, clashing, frame, prose, rows, words


def shingle_set(text):
    w = words(text)
    return frozenset(" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None


def brute(docs):
    """Classes by all pairs."""
    sets = {d: shingle_set(t) for d, t, *_ in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and both / len(sets[a] | sets[b]) >= 0.8:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in sets}


def edited(rng, text, share):
    w = text.split()
    for i in rng.sample(range(len(w)), int(share * len(w))):
        w[i] = prose(rng, 1)
    return " ".join(w)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(21)
    out = rows(n=40)
    at = 1000
    for size, share in ((2, 0.01), (5, 0.02), (40, 0.015), (60, 0.03)):
        base = prose(rng, 300)
        out.append((at, base, "en", "s", 0))
        out += [(at + 1 + i, edited(rng, base, share), "en", "s", 0) for i in range(size)]
        at += 200
    chain = prose(rng, 400)
    for i in range(8):  # each like the one before, the ends unlike
        out.append((at + i, chain, "en", "s", 0))
        chain = edited(rng, chain, 0.02)
    out += [(at + 50, "Short text", "en", "s", 0), (at + 51, "short, TEXT!", "en", "s", 0), (at + 52, "other text", "en", "s", 0)]
    return out


def test_classes_match_all_pairs(spark, docs):
    got = {r.doc_id: r.class_id for r in n.near_classes(clashing(frame(spark, docs))).collect()}
    assert got == brute(docs)


def test_stage_keeps_one_of_each_class(spark, docs):
    df = clashing(frame(spark, [d for d in docs if d[0] != 7]))
    out = n.near_dedup(df)
    assert out.columns == df.columns
    want = brute([d for d in docs if d[0] != 7])
    assert sorted(r.doc_id for r in out.collect()) == sorted({d for d in want if want[d] == d})


def test_registers_estimate_weighted_jaccard():
    import numpy as np

    a, b = np.arange(1, 300, dtype=np.uint64), np.arange(31, 330, dtype=np.uint64)
    text = np.concatenate([np.zeros(len(a), int), np.ones(len(b), int)])
    r = n.prob_min_hash(text, np.concatenate([a, b]), np.ones(len(text)), 2, 4000)
    truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((r[0] == r[1]).mean() - truth) < 0.03
    scaled = n.prob_min_hash(np.repeat([0, 1], 50), np.tile(a[:50], 2), np.repeat([1.0, 7.0], 50), 2, 500)
    assert (scaled[0] == scaled[1]).mean() > 0.9  # weights count only in proportion


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 100), (102, 101), (200, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_empty_table(spark):
    assert n.near_classes(frame(spark, [], SCHEMA, 1)).count() == 0


@pytest.mark.parametrize("work", [1000, 0])  # by tiles at once, and after rounds of leaders
def test_components_of_a_large_bucket_meet(spark, work):
    rng = random.Random(5)
    base = prose(rng, 200)
    near = {i: edited(rng, base, 0.005) for i in range(10)}  # 0 to 6 are one component, 7 and 8 are two, 9 is met by nobody
    near[20] = prose(rng, 200)
    large = spark.createDataFrame([(b, i) for b in (1, 2) for i in near] + [(3, 0), (3, 1)], "bucket bigint, rep bigint")
    whole = spark.createDataFrame([(i, 0) for i in range(7)], "node bigint, component bigint")
    sets = frame(spark, [(i, t, "en", "s", 0) for i, t in near.items()]).selectExpr("doc_id rep", "text").select("rep", n.sketch("text").registers.alias("registers"), n.shingle_set("text").alias("shingles"))
    parts = {r.node: r.component for r in n._rest(large, whole, sets.select("rep", "registers"), sets, work).collect()}
    assert parts == dict.fromkeys(range(10), 0)


def test_leaders_and_tiles_agree(spark, docs, monkeypatch):
    monkeypatch.setattr(n, "TILE_MEMBERS", 3)
    want = brute(docs)
    rest = n._rest
    for work in (0, 2):
        monkeypatch.setattr(n, "_rest", lambda large, whole, reps, sets: rest(large, whole, reps, sets, work))
        assert {r.doc_id: r.class_id for r in n.near_classes(frame(spark, docs)).collect()} == want


def test_repeated_ids(spark):
    rng = random.Random(12)
    one, two = prose(rng, 100), prose(rng, 100)
    docs = [(5, one), (5, two), (7, two + " end"), (9, one + " end"), (9, one + " end"), (4, "  "), (4, "  "), (None, one)]
    df = clashing(frame(spark, [(*d, "en", "s", 0) for d in docs]))
    got = n.near_classes(df).collect()
    assert sorted((r.doc_id or 0, r.class_id) for r in got) == [(0, 5), (4, 4), (4, 4), (5, 5), (5, 5), (7, 5), (9, 5), (9, 5)]
    kept = n.near_dedup(df)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(5, one), (5, two), (4, "  "), (4, "  ")])
    assert kept.columns == df.columns


def test_repeated_lines_do_not_weigh(spark):
    rng = random.Random(9)
    line, out = prose(rng, 24), []
    for i in range(12):
        text = prose(rng, 80)
        out += [(2 * i, f"{line}\n{text}", "en", "s", 0), (2 * i + 1, f"{line}\n" * 1000 + text, "en", "s", 0)]
    assert {r.doc_id: r.class_id for r in n.near_classes(frame(spark, out)).collect()} == brute(out)


def test_null_ids(spark):
    rng = random.Random(11)
    one, two, three = prose(rng, 200), prose(rng, 60), prose(rng, 60)
    docs = [(None, one), (5, one), (3, one + " end"), (None, two), (None, two), (None, three), (8, None), (None, None)]
    df = frame(spark, [(*d, "en", "s", 0) for d in docs])
    out = sorted(((r.doc_id or 0, r.class_id or 0, r.kept) for r in n.near_classes(df).collect()))
    assert out == sorted([(0, 3, False), (5, 3, False), (3, 3, True), (0, 0, True), (0, 0, False), (0, 0, True), (8, 8, True), (0, 0, True)])
    kept = sorted((r.doc_id or 0, r.text or "") for r in n.near_dedup(df).collect())
    assert kept == sorted([(3, one + " end"), (0, two), (0, three), (8, ""), (0, "")])
