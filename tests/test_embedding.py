import pytest

from lorebank.sources import embedding as e


def test_a_failed_run_is_taken_up_again(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i % 30}") for i in range(50)] + [(50, None), (51, "")], "id int, text string").repartition(3)
    log, poison = tmp_path / "asked", tmp_path / "poison"

    def embedder(texts):
        with open(log, "a") as f:
            f.writelines(f"{t}\n" for t in texts)
        if poison.exists() and "text 7" in texts:
            raise RuntimeError("no answer")
        return [[float(len(t)), 1.0] for t in texts]

    root = f"{tmp_path}/ledger"
    poison.touch()
    with pytest.raises(Exception, match="no answer"):
        e.embed_missing(docs, "text", root, embedder, parts=6, tries=0)
    kept = e.ledger(spark, root).count()
    assert 0 <= kept < 31
    poison.unlink()
    log.write_text("")
    assert e.embed_missing(docs, "text", root, embedder, parts=6) == 31 - kept
    asked = log.read_text().split("\n")[:-1]
    assert len(asked) == len(set(asked)) == 31 - kept
    assert e.embed_missing(docs, "text", root, embedder) == 0
    out = e.with_embeddings(docs, "text", root).collect()
    assert len(out) == 52 and all(r.embedding == [float(len(r.text or "")), 1.0] for r in out) and set(out[0].asDict()) == {"id", "text", "embedding"}
    more = docs.limit(1).selectExpr("id", "'a new one' as text")
    assert e.with_embeddings(more, "text", root).first().embedding is None
    assert e.embed_missing(more, "text", root, embedder) == 1 and e.embed_missing(docs.limit(0), "text", root, embedder) == 0
