import pytest
from pyspark.sql import functions as F

from lorebank.operators import chunking, kb, store
from lorebank.sources import io

SCHEMA = "id string, tenant_id string, brand_id string, content string, embedding array<float>, active boolean"


def rows(spark, ids, tag="old", tenant=None):
    data = [(f"r{i}", tenant or ("big" if i % 4 else ("t1" if i % 8 else None)), "b", f"{tag} {i}", [float(i)] if i % 3 else None, i % 7 != 0) for i in ids]
    return spark.createDataFrame(data, SCHEMA)


def plain(df):
    return sorted(map(tuple, df.select("id", "tenant_id", "brand_id", "content", "embedding", "active").collect()), key=str)


def test_upserts_rewrite_what_changes(spark, tmp_path):
    s = store.create_store(rows(spark, range(60)), str(tmp_path), buckets=8)
    assert plain(store.read_store(spark, s)) == plain(rows(spark, range(60)))
    new = rows(spark, [3, 5, 70], "new").drop("embedding")
    want = plain(kb.upsert(rows(spark, range(60)), new))
    first = store.upsert_store(s, new)
    assert 1 <= len(first) <= 3 and plain(store.read_store(spark, s)) == want
    before = s.state(spark)
    assert store.upsert_store(s, new) == [] and s.state(spark) == before  # a repeated run changes nothing
    again = new.withColumn("content", F.when(F.col("id") == "r5", "newer").otherwise(F.col("content")))
    assert len(store.upsert_store(s, again)) == 1
    assert plain(store.read_store(spark, s, before)) == want  # the version of before is still whole
    gens = {b: g for b, g in s.state(spark)["parts"].items() if before["parts"][b] != g}
    assert len(gens) == 1


def test_nulls_order_and_moved_tenants(spark, tmp_path):
    s = store.create_store(rows(spark, range(10)), str(tmp_path), buckets=4)
    moved = rows(spark, [1, 2], "x", "elsewhere").withColumn("n", F.lit(2)).unionByName(rows(spark, [1, 2], "y", "t1").withColumn("n", F.lit(1)))
    nothing = moved.withColumn("content", F.when(F.col("id") == "r2", None).otherwise(F.col("content")))
    store.upsert_store(s, nothing, "n")
    got = {r.id: r for r in store.read_store(spark, s).collect()}
    assert len(got) == 10 and got["r1"].tenant_id == "elsewhere" and got["r1"].content == "x 1" and got["r2"].content is None
    assert store.upsert_store(s, nothing, "n") == []
    assert store.upsert_store(s, nothing.limit(0), "n") == []


def test_empty_tables(spark, tmp_path):
    s = store.create_store(rows(spark, []), str(tmp_path))
    assert store.read_store(spark, s).count() == 0
    store.upsert_store(s, rows(spark, [1]))
    assert [r.id for r in store.read_store(spark, s).collect()] == ["r1"]
    with pytest.raises(ValueError):
        store.read_store(spark, store.KbStore(f"{tmp_path}/none"))


def test_only_the_tenants_files_are_read(spark, tmp_path):
    s = store.create_store(rows(spark, range(80)), str(tmp_path), buckets=4)
    own = store.visible_in_store(spark, s, "t1")
    assert plain(own) == plain(kb.visible(rows(spark, range(80)), "t1"))
    assert all("tenant_id=t1" in f for f in own.select("id", F.input_file_name().alias("f")).toPandas().f)
    plan = own._jdf.queryExecution().toString()
    assert "tenant_id" in plan.split("PartitionFilters")[1][:200]
    asked = spark.createDataFrame([("t1",), (None,), ("t9",)], "tenant_id string")
    met = store.rows_of_tenants(s, asked)
    assert plain(met) == plain(own)
    assert "dynamicpruning" in met._jdf.queryExecution().executedPlan().toString().lower()
    big = store.visible_in_store(spark, s, "big").select(F.input_file_name().alias("f")).distinct().count()
    assert big == 4  # the largest tenant is spread over all buckets


class Killed(Exception):
    pass


def test_a_replayed_batch_is_skipped(spark, tmp_path, monkeypatch):
    text = lambda n: f"---\nepisode_number: {n}\n---\n## [00:00:10] One\n" + f"word {n} " * 20
    for n in (1, 2):
        (tmp_path / f"in/EP-{n}").mkdir(parents=True)
        (tmp_path / f"in/EP-{n}/transcript.md").write_text(text(n))
    s = store.create_store(spark.createDataFrame([], "id string, tenant_id string, content string"), f"{tmp_path}/kb", buckets=4)
    chunk = lambda files: chunking.chunk_transcripts(files).select("id", F.lit("t").alias("tenant_id"), "content")

    def run(after=None):
        stream = io.stream_markdown(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/done", 10)
        writer = store.ingest_to_store(stream, chunk, s, "episodes").option("checkpointLocation", f"{tmp_path}/at")
        if after:
            real = store.upsert_store
            monkeypatch.setattr(store, "upsert_store", lambda *a: (real(*a), after())[0])
        q = writer.trigger(availableNow=True).start()
        try:
            q.awaitTermination(120)
        finally:
            monkeypatch.undo()
            q.stop()

    def die():
        raise Killed

    with pytest.raises(Exception, match="Killed"):
        run(die)  # written, but the query died before it noted the batch
    state = s.state(spark)
    assert state["ledger"] == {"episodes": 0} and store.read_store(spark, s).count() == 2
    run()
    assert s.state(spark) == state  # the batch came again and was skipped
    (tmp_path / "in/EP-3").mkdir()
    (tmp_path / "in/EP-3/transcript.md").write_text(text(3))
    run()
    assert sorted(r.id for r in store.read_store(spark, s).collect()) == [f"hub-ep00{n}-ts000010" for n in (1, 2, 3)]
    assert s.state(spark)["ledger"]["episodes"] == 1
