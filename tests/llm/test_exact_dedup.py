import hashlib

import pytest

from lorebank.llm.exact_dedup import exact_dedup, exact_groups
from tests.llm.helpers import LOW, SCHEMA, clashing, frame, rows


def brute(docs):
    groups = {}
    for d, t, *_ in docs:
        groups.setdefault((t or "").translate(LOW), []).append(d)
    return groups


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_groups(spark, partitions):
    docs = rows() + [(2000 + i, "Hot COPY" if i % 2 else "hot copy", "en", "s", 0) for i in range(60)]
    out = exact_groups(clashing(frame(spark, docs)), partitions).collect()
    groups, text = brute(docs), {d: (t or "").translate(LOW) for d, t, *_ in docs}
    assert len(out) == len(docs)
    for r in out:
        own = groups[text[r.doc_id]]
        assert (r.keep_id, r.group_size, r.text_sha256) == (max(own), len(own), hashlib.sha256(text[r.doc_id].encode()).hexdigest())
    assert sorted(r.doc_id for r in out if r.kept) == sorted(max(g) for g in groups.values())


def test_stage_keeps_one_of_each(spark):
    docs = rows()
    df = clashing(frame(spark, docs))
    out = exact_dedup(df, 4)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(max(g) for g in brute(docs).values())
    plain = [r for r in docs if r[0] != 7]
    assert sorted(r.doc_id for r in exact_dedup(frame(spark, plain)).collect()) == sorted(max(g) for g in brute(plain).values())


def test_ids_that_repeat_with_other_texts(spark):
    docs = [(1, "a", "en", "s", 0), (1, "b", "en", "s", 0), (2, "A", "en", "s", 0)]
    assert sorted((r.doc_id, r.text) for r in exact_dedup(frame(spark, docs)).collect()) == [(1, "b"), (2, "A")]


def test_empty_table(spark):
    assert exact_groups(frame(spark, [], SCHEMA, 1)).count() == 0


@pytest.mark.parametrize("partitions", [1, 3])
def test_null_ids(spark, partitions):
    big = 2**53 + 1
    docs = [(big, "one", "en", "s", 0), (None, "One", "en", "s", 0), (None, "two", "en", "s", 0), (None, "two", "en", "s", 0), (None, "three", "en", "s", 0), (4, "four", "en", "s", 0)]
    df = frame(spark, docs)
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in ("one", "two", "three", "four")}
    out = sorted(((sha[r.text_sha256], r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in exact_groups(df, partitions).collect()), key=str)
    assert out == sorted(
        [("one", big, big, 2, True), ("one", 0, big, 2, False), ("two", 0, None, 2, True), ("two", 0, None, 2, False), ("three", 0, None, 1, True), ("four", 4, 4, 1, True)], key=str
    )
    assert sorted((r.doc_id or 0, r.text) for r in exact_dedup(df, partitions).collect()) == [(0, "three"), (0, "two"), (4, "four"), (big, "one")]
    single = frame(spark, [docs[0], docs[4], docs[5]])
    assert sorted(r.text for r in exact_dedup(single, partitions).collect()) == ["four", "one", "three"]
