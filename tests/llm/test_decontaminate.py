import hashlib

import pytest

from lorebank.llm import decontaminate as d
from tests.llm.helpers import LOW, SCHEMA, clashing, frame, rows, words

UP = {v: k for k, v in LOW.items()}
ITEMS = "item_id bigint, text string"


@pytest.fixture(scope="module")
def data():
    docs = rows()
    long = words(docs[63][1])
    items = [(1, " ".join(words(docs[10][1])[:14]) or "zz"), (2, " ".join(long[500:530])), (3, "Only, Three. words"), (4, None), (5, ""), (6, " ".join(long[505:515]).translate(UP)), (11, "never seen " * 8)]
    docs.append((900, "some ONLY three WORDS here and only three", "en", "s", 0))
    docs.append((901, "x " + " ".join(long[500:530]).translate(UP) + " y " + " ".join(long[508:519]), "en", "s", 0))
    return docs, items


def brute(docs, items, window=10):
    out = []
    for doc, text, *_ in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            own = words(t)
            n = min(window, len(own))
            grams = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
            for i in range(len(w) - n + 1):
                if n and tuple(w[i : i + n]) in grams:
                    hit.update(range(i, i + n))
                    found.add(item)
        out.append((doc, len(w), len(hit), tuple(sorted(found))))
    return sorted(out)


@pytest.mark.parametrize("limit", [d.MAX_BLOCK_BYTES, 300])
def test_hits_match_brute_force(spark, data, limit):
    docs, items = data
    got = d.scan_hits(clashing(frame(spark, docs)), frame(spark, items, ITEMS), max_block_bytes=limit).collect()
    want = brute(docs, items)
    assert sorted((r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"]))) for r in got) == want


def test_query_columns(spark, data, tmp_path):
    docs, items = data
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    frame(spark, items, ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in d.op2_decontaminate(spark, str(tmp_path)).collect()}
    assert got[901].items_sha256 == hashlib.sha256(b"2,6").hexdigest() and got[901].contaminated
    assert got[60].items_sha256 == hashlib.sha256(b"").hexdigest() and not got[60].contaminated


def test_documents_and_spans_removed(spark, data):
    docs, items = data
    df, marks = clashing(frame(spark, docs)), frame(spark, items, ITEMS)
    kept = d.decontaminate(df, marks)
    hit = {r[0] for r in brute(docs, items) if r[2]}
    assert kept.columns == df.columns and kept.count() == sum(r[0] not in hit for r in docs)
    cut = {r.doc_id: r.text for r in d.decontaminate(df, marks, remove="spans").collect()}
    assert cut[900] == "some  here and only three" and cut[901] == "x  y "
    assert cut[0] == docs[0][1]


def test_empty_tables(spark):
    none = frame(spark, [], ITEMS, 1)
    assert d.scan_hits(frame(spark, rows()), none).filter("n_hit > 0").count() == 0
    assert d.decontaminate(frame(spark, rows()), none).count() == len(rows())
    assert d.scan_hits(frame(spark, [], SCHEMA, 1), frame(spark, [(1, "a b")], ITEMS)).count() == 0


@pytest.mark.parametrize("limit", [d.MAX_BLOCK_BYTES, 150])
def test_results_do_not_depend_on_blocks(spark, limit):
    w = [f"w{i}" for i in range(40)]
    items = [(k, " ".join(w[k : k + 12])) for k in range(0, 28, 4)] + [(90, "a b")]
    docs = [(1, " ".join(["x", *w, "y"]), "en", "s", 0)] * 3 + [(2, "a " + " ".join(w[:12]) + " b", "en", "s", 0), (None, "a b c", "en", "s", 0), (3, None, None, None, 0)]
    df, marks = clashing(frame(spark, docs)), frame(spark, items, ITEMS)
    got = d.scan_hits(df, marks, max_block_bytes=limit).collect()
    assert sorted(((r.doc_id or 0, r.n_words, r.n_hit, tuple(sorted(r["items"]))) for r in got)) == sorted((i or 0, *r) for i, *r in (brute([x], items)[0] for x in docs))
    cut = d.decontaminate(df, marks, remove="spans", max_block_bytes=limit)
    assert cut.columns == df.columns
    texts = [(r.doc_id, r.text) for r in cut.collect()]
    assert sorted(texts, key=str) == sorted([(1, "x  w36 w37 w38 w39 y")] * 3 + [(2, "a  b"), (None, " c"), (3, None)], key=str)


def test_many_blocks_hold_one_index_a_task(spark):
    docs, items = _case()
    bench = frame(spark, items, "item_id bigint, text string")
    table = clashing(frame(spark, docs))
    for remove in ("documents", "spans"):
        one, many = d.decontaminate(table, bench, remove), d.decontaminate(table, bench, remove, max_block_bytes=300)
        plan = many._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") <= 1 and many.columns == one.columns
        assert sorted(map(str, many.collect())) == sorted(map(str, one.collect()))
    kept = {r.doc_id for r in d.decontaminate(table, bench, max_block_bytes=300).collect()}
    assert None in kept and 0 < len(kept) < len({i for i, *_ in docs})


def _case():
    docs = rows(n=30) + [(None, "clean and short", None, None, None), (None, None, None, None, None)]
    items = [(i, " ".join((docs[i][1] or "").split()[:14])) for i in range(0, 30, 3)] + [(99, None), (98, "")]
    return docs, items
