import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lorebank.operators import evaluate
from lorebank.sources import io


def test_markdown_tree(spark, tmp_path):
    for name, text in (("EP-1/summary.md", "a\nb"), ("EP-22/summary.md", "c"), ("EP-x/summary.md", "no"), ("EP-3/transcript.md", "t")):
        os.makedirs(tmp_path / os.path.dirname(name), exist_ok=True)
        (tmp_path / name).write_text(text)
    assert sorted(tuple(r) for r in io.read_markdown(spark, str(tmp_path), "summary").collect()) == [("EP-1", "summary", "a\nb"), ("EP-22", "summary", "c")]


def test_csv_cells(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a "b", c\nd', None), ("2", "plain", "x")], "id string, topic string, text string").withColumn("active", F.lit("true"))
    io.write_kb_csv(df.coalesce(1), f"{tmp_path}/out")
    lines = "".join(open(f"{tmp_path}/out/{f}").read() for f in os.listdir(f"{tmp_path}/out") if f.startswith("part"))
    assert '1,"a ""b"", c d",,true' in lines and "2,plain,x,true" in lines
    assert sorted((r.id, r.topic) for r in io.read_kb_csv(spark, f"{tmp_path}/out").collect()) == [("1", 'a "b", c d'), ("2", "plain")]


def test_keyed_json_and_golden(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"001": "2021-01-04", "002": None}))
    assert sorted(tuple(r) for r in io.read_keyed_json(spark, f"{tmp_path}/d.json", "string").collect()) == [("001", "2021-01-04"), ("002", None)]
    (tmp_path / "g.json").write_text(json.dumps({"questions": [{"id": "q1", "type": "vague", "question": "?", "expected_episodes": [3], "expected_keywords": ["x"]}, {"id": "q2", "type": "offtopic", "question": "!"}]}, indent=1))
    assert sorted((r.query_id, r.type, r.expected) for r in io.read_golden(spark, f"{tmp_path}/g.json").collect()) == [("q1", "vague", [3]), ("q2", "offtopic", [])]


def test_eval_runs_round_trip(spark, tmp_path):
    golden = spark.createDataFrame([("a", "specific", "Why?", [5])], "query_id string, type string, question string, expected array<int>")
    got = spark.createDataFrame([("a", 1, 5, 0.5)], "query_id string, pos int, episode int, similarity double")
    io.write_eval_run(spark, evaluate.judge(golden, got), got, str(tmp_path), "vector", 8, 17)
    r = io.read_eval_runs(spark, str(tmp_path)).first()
    assert (r.query_id, r.mode, r.question, r.hit, r["rank"], r.got) == ("a", "vector", "Why?", True, 1, [5])


def test_embedder_batches_and_retries(spark):
    def embedder(texts):
        assert len(texts) <= 3
        return [[float(len(t))] for t in texts]

    df = spark.createDataFrame([(i, "x" * i) for i in range(10)], "id int, text string").coalesce(1)
    assert [(r.id, r.embedding) for r in io.embed(df, "text", embedder, batch=3).collect()] == [(i, [float(i)]) for i in range(10)]
    waits, calls = [], []

    def shaky(x):
        calls.append(x)
        if len(calls) < 4:
            raise OSError("busy")
        return x

    assert io.retried(shaky, sleep=waits.append)(1) == 1 and waits == [1, 2, 4]
    with pytest.raises(OSError):
        io.retried(lambda: (_ for _ in ()).throw(OSError()), 1, sleep=waits.append)()


def test_chunk_collection_and_documents(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], T.StructType([T.StructField("id", T.LongType()), T.StructField("content", T.StringType())]))
    io.write_chunks(df, f"{tmp_path}/c")
    (tmp_path / "array.json").write_text('[{"id": 1, "content": "a"},\n {"id": 2}]')
    assert sorted((r.id, r.content) for r in io.read_chunks(spark, f"{tmp_path}/array.json", df.schema).collect()) == [(1, "a"), (2, None)]
    docs = spark.createDataFrame([("EP-1", "T", "T", "s" * 6000, "", "", "", True, False, False, False)], "id string, title_en string, title_es string, summary_en string, summary_es string, transcript_en string, transcript_es string, has_summary boolean, has_summary_translated boolean, has_transcript boolean, has_transcript_translated boolean")
    io.write_episode_docs(docs, f"{tmp_path}/docs")
    assert spark.read.json(f"{tmp_path}/docs/index").select(F.length("summary_en").alias("n")).first().n == 5000
    assert spark.read.json(f"{tmp_path}/docs/episodes").count() == 1


def test_chunks_round_trip_and_arrays(spark, tmp_path):
    rows = spark.range(20).select(F.col("id").cast("string").alias("id"), F.lit("x\ny [z").alias("content"))
    io.write_chunks(rows.coalesce(2), f"{tmp_path}/lines")
    assert sorted(tuple(r) for r in io.read_chunks(spark, f"{tmp_path}/lines", rows.schema).collect()) == sorted(tuple(r) for r in rows.collect())
    (tmp_path / "array.json").write_text(json.dumps([{"id": "1", "content": "a"}, {"id": "2", "content": None}], indent=1))
    assert sorted((r.id, r.content) for r in io.read_chunks(spark, f"{tmp_path}/array.json").collect()) == [("1", "a"), ("2", None)]
