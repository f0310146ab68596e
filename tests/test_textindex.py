import random

import pytest
from pyspark.sql import functions as F

from lorebank.operators import lexical
from lorebank.operators import textindex as ti

QUERIES = ["casa", "casa perro", '"casa perro"', "casa or sol", "perro -casa", '"sol casa" or luna', "nada", "", "casa nada", "casa casa", "or", "LUNA", "luna sol casa", "-casa", 'perro -"casa perro"', "casa or nada sol"]


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    words = ["casa"] * 12 + ["perro"] * 6 + ["sol"] * 3 + ["luna", "río", "mar"] + [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40))), f"t{i % 3}") for i in range(n)]
    return docs + [(n, None, "t0"), (n + 1, "", "t1"), (n + 2, "casa " * 500 + "perro", None), (n + 3, "casa", "t2")]


def asked(spark, scoped=False):
    rows = [(i, q, f"t{i % 3}") for i, q in enumerate(QUERIES)] + [(100, "casa", "t1"), (101, None, "t0")]
    df = spark.createDataFrame(rows, "query_id int, query_text string, scope string")
    return df if scoped else df.drop("scope")


def rows_of(df):
    return sorted((r.query_id, r["rank"], r.id, round(r.text_rank, 9)) for r in df.collect())


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(ti, "BLOCK", 4)



def test_equal_to_a_search_without_an_index(spark, tmp_path, small_blocks):
    docs = spark.createDataFrame(corpus(), "id bigint, content string, scope string").repartition(5)
    index = ti.build_text_index(docs, str(tmp_path), buckets=3)
    want = rows_of(lexical.text_topk(asked(spark), lexical.token_rows(docs), 7))
    assert rows_of(ti.indexed_topk(asked(spark), index, 7)) == want and len(want) > 60
    some = docs.filter("id % 3 = 1").select("id")
    assert rows_of(ti.indexed_topk(asked(spark), index, 7, some)) == rows_of(lexical.text_topk(asked(spark), lexical.token_rows(docs), 7, rows=some))
    stats = ti.index_stats(spark, index).first()
    pairs = lexical.token_rows(docs).select("id", "term").distinct()
    assert (stats.terms, stats.postings, stats.held) == (pairs.select("term").distinct().count(), pairs.count(), pairs.count())
    assert spark.read.parquet(f"{tmp_path}/postings").agg(F.max("n")).first()[0] < 40  # a frequent term is spread


def test_within_scopes(spark, tmp_path, small_blocks):
    docs = spark.createDataFrame(corpus(), "id bigint, content string, scope string")
    index = ti.build_text_index(docs, str(tmp_path), scope="scope", buckets=3)
    want = rows_of(lexical.text_topk(asked(spark, True), lexical.token_rows(docs), 5, rows=docs.select("id", "scope")))
    assert rows_of(ti.indexed_topk(asked(spark, True), index, 5)) == want and len(want) > 20


def test_added_removed_and_merged(spark, tmp_path, small_blocks):
    docs = {d: (t, s) for d, t, s in corpus()}
    frame = lambda rows: spark.createDataFrame([(d, *x) for d, x in rows.items()], "id bigint, content string, scope string")
    index = ti.build_text_index(frame(docs), str(tmp_path), buckets=2)
    check = lambda: rows_of(ti.indexed_topk(asked(spark), index, 6)) == rows_of(lexical.text_topk(asked(spark), lexical.token_rows(frame(docs)), 6))
    new = {5: ("luna luna luna casa", "t0"), 9: ("", "t0"), 402: ("sol", "t1"), 900: ("casa perro sol luna", "t2")}
    ti.add_documents(index, frame(new))
    docs |= new
    assert check()
    ti.remove_documents(index, spark.createDataFrame([(900,), (3,), (12345,)], "id bigint"))
    docs.pop(900), docs.pop(3)
    assert check()
    ti.add_documents(index, frame({900: ("perro casa", "t1")}))
    docs[900] = ("perro casa", "t1")
    assert check()
    ti.merge_segments(spark, index)
    state = index.state(spark)
    assert check() and len(state["segments"]) == 1 and state["removed"] == []
    ti.add_documents(index, frame(new))
    docs |= new
    assert check()


def test_an_unfinished_change_is_not_seen(spark, tmp_path):
    docs = spark.createDataFrame([(1, "casa"), (2, "sol")], "id bigint, content string")
    index = ti.build_text_index(docs, str(tmp_path))
    ti._write_segment(ti.document_terms(spark.createDataFrame([(3, "casa")], "id bigint, content string"), "plain", "id", "content", None), str(tmp_path), 2, 32)
    assert [r.id for r in ti.indexed_topk(asked(spark).filter("query_id = 0"), index).collect()] == [1]
    ti.add_documents(index, spark.createDataFrame([(4, "casa")], "id bigint, content string"))
    assert sorted(r.id for r in ti.indexed_topk(asked(spark).filter("query_id = 0"), index).collect()) == [1, 4]
    with pytest.raises(ValueError):
        ti.indexed_topk(asked(spark), ti.TextIndex(f"{tmp_path}/none")).collect()


def test_spanish_and_text_ids(spark, tmp_path):
    docs = spark.createDataFrame([("a", "Los perros corrían por las casas"), ("b", "una casa"), ("c", "gatos")], "key string, body string")
    index = ti.build_text_index(docs, str(tmp_path), "spanish", "key", "body", buckets=2)
    q = spark.createDataFrame([(1, "la casa"), (2, "perro casas"), (3, "de los")], "query_id int, query_text string")
    assert sorted((r.query_id, r.id) for r in ti.indexed_topk(q, index).collect()) == [(1, "a"), (1, "b"), (2, "a")]


def test_the_plan_reads_only_the_terms_buckets(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"w{i} casa") for i in range(300)], "id bigint, content string")
    index = ti.build_text_index(docs, str(tmp_path))
    out = ti.indexed_topk(spark.createDataFrame([(1, "w7")], "query_id int, query_text string"), index)
    plan = out._jdf.queryExecution().toString()
    assert [r.id for r in out.collect()] == [7]
    assert "bucket" in plan.split("PartitionFilters")[1][:120]
    assert "term" in plan.split("PushedFilters")[1][:200] and "content" not in plan


def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "id bigint, content string")
    index = ti.build_text_index(docs, str(tmp_path), buckets=2)
    assert ti.indexed_topk(asked(spark), index).count() == 0
    ti.add_documents(index, spark.createDataFrame([(1, "casa")], "id bigint, content string"))
    assert ti.indexed_topk(asked(spark), index).count() > 0 and ti.indexed_topk(asked(spark).limit(0), index).count() == 0
