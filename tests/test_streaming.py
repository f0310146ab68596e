from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lorebank.operators import chunking, kb
from lorebank.streaming import jobs

T0 = datetime(2024, 1, 1)
MESSAGES = [("m1", 1, 0, "answer", "a"), ("m2", 1, 60, "sources", None), ("m1", 1, 61, "answer", "again"), ("m3", 2, 5, "sources", None), ("m4", 1, 61 + 6 * 60 + 1, "answer", "late"), ("m5", 1, 430, "sources", None)]


@pytest.fixture
def messages(spark):
    rows = [(m, u, T0 + timedelta(minutes=t), k, v) for m, u, t, k, v in MESSAGES]
    return spark.createDataFrame(rows, "message_id string, user_id bigint, ts timestamp, kind string, value string")


@pytest.fixture
def stream(spark, messages, tmp_path):
    messages.coalesce(1).write.parquet(f"{tmp_path}/in")
    return spark.readStream.schema(messages.schema).parquet(f"{tmp_path}/in")


def run(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    q.processAllAvailable()
    q.stop()
    return df.sparkSession.table(name)


def test_dedup(spark, messages, stream):
    assert sorted(r.message_id for r in run(jobs.dedup_messages(stream), "dedup").collect()) == ["m1", "m2", "m3", "m4", "m5"]
    assert {(r.message_id, r.value) for r in jobs.dedup_batch(messages).collect() if r.message_id == "m1"} == {("m1", "a")}


def test_sessions(spark, messages, stream):
    want = [(1, T0, 3), (1, T0 + timedelta(minutes=422), 2), (2, T0 + timedelta(minutes=5), 1)]
    assert sorted((r.user_id, r.start, r.messages) for r in jobs.sessions(messages).collect()) == want
    got = run(jobs.sessions(stream, watermark="1 minute"), "sessions", "complete")
    assert sorted((r.user_id, r.start, r.messages) for r in got.collect()) == want
    edge = spark.createDataFrame([(1, T0), (1, T0 + timedelta(hours=6))], "user_id bigint, ts timestamp")
    assert jobs.sessions(edge).count() == 1


def test_last_answer(spark, messages, stream):
    want = [(1, "a"), (1, "late"), (2, None)]
    assert sorted(((r.user_id, r.value) for r in jobs.answer_sources_batch(messages, "message_id").collect()), key=str) == want
    assert [r.value for r in jobs.last_value(messages.filter("kind = 'answer'"), "user_id", "value", F.col("ts")).collect()] == ["late"]
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        got = run(jobs.answer_sources(stream), "answers")
        assert sorted(((r.user_id, r.value) for r in got.collect()), key=str) == want
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


@pytest.mark.parametrize("expires", [None, 3600])
def test_streamed_answers_equal_the_table(spark, tmp_path, expires):
    at = lambda m: T0 + timedelta(minutes=m)
    batches = [
        [(1, at(0), "answer", "a"), (1, at(1), "answer", None), (1, at(2), "sources", None), (2, at(3), "answer", "b"), (3, at(4), "answer", None)],
        [(1, at(30), "answer", "c"), (1, at(10), "sources", None), (3, at(20), "sources", None), (2, at(55), "sources", None)],
        [(1, at(100), "sources", None), (2, at(300), "sources", None), (1, at(80), "sources", None)],
        [(4, at(400), "answer", "d")],
        [(4, at(401), "sources", None)],
    ]
    if expires is None:  # without a watermark a request behind the last answer is not known to come
        batches[1][1] = (1, at(31), "sources", None)
    kinds = "user_id bigint, ts timestamp, kind string, value string"
    stream = spark.readStream.schema(kinds).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    name = f"streamed_{expires}"
    (tmp_path / "in").mkdir()
    sizes = []
    try:
        q = jobs.answer_sources(stream, expires, "1 hour").writeStream.format("memory").queryName(name).outputMode("append").start()
        for i, rows in enumerate(batches):
            spark.createDataFrame(rows, kinds).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
            q.processAllAvailable()
            sizes.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
        q.stop()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    table = spark.createDataFrame([r for rows in batches for r in rows], kinds)
    twin = jobs.answer_sources_batch(table, expires=expires)
    plain = lambda df: sorted(((r.user_id, r.ts, r.value) for r in df.select("user_id", "ts", "value").collect()), key=str)
    assert plain(spark.table(name)) == plain(twin)
    values = {(r.user_id, r.ts): r.value for r in twin.collect()}
    assert values[2, at(300)] == (None if expires else "b") and values[1, at(100)] == (None if expires else "c") and values[3, at(20)] is None
    assert expires is None or sizes[-1] < max(sizes)


def test_last_answer_over_days(spark):
    day = timedelta(days=1)
    rows = [(1, T0, "answer", "a"), (1, T0 + 2 * day, "sources", None), (1, T0 + 3 * day, "answer", None), (1, T0 + 3 * day, "sources", "x"), (1, T0 + 4 * day, "answer", "b"), (1, T0 + 4 * day, "sources", None)]
    rows += [(1, T0 + 9 * day, "sources", None), (2, T0, "sources", None), (None, T0, "answer", "n"), (None, T0 + day, "sources", None), (1, None, "sources", None)]
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, user_id bigint, ts timestamp, kind string, value string")
    want = {1: "a", 3: "a", 5: "b", 6: "b", 7: None, 9: "n", 10: None}
    for span in ("day", "hour", "year"):
        out = jobs.answer_sources_batch(table, "n", span)
        assert out.columns == table.columns and {r.n: r.value for r in out.collect()} == want
    assert jobs.answer_sources_batch(table.limit(0), "n").count() == 0


def test_retrieve_for_each_message(spark, messages, stream):
    seen = []
    q = jobs.retrieve_each(stream, lambda b: b.filter("kind = 'sources'").select("message_id"), lambda df, n: seen.extend(r.message_id for r in df.collect())).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(seen) == ["m2", "m3", "m5"]


def test_files_ingested_twice_are_once(spark, tmp_path):
    text = "## [00:00:10] One\n" + "a" * 50
    spark.createDataFrame([("EP-1", text)], "episode_id string, text string").coalesce(1).write.parquet(f"{tmp_path}/f")
    stream = spark.readStream.schema("episode_id string, text string").parquet(f"{tmp_path}/f")
    state = {"kb": spark.createDataFrame([], "id string, content string")}

    def write(chunks, n):
        for _ in range(2):
            state["kb"] = spark.createDataFrame(kb.upsert(state["kb"], chunks.select("id", "content")).collect(), "id string, content string")

    q = jobs.ingest_files(stream, chunking.chunk_transcripts, write).start()
    q.processAllAvailable()
    q.stop()
    assert [r.id for r in state["kb"].collect()] == ["hub-ep001-ts000010"]
