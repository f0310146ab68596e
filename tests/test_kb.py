import re

import pytest
from pyspark.sql import functions as F

from lorebank.operators import catalog, chunking, citations, kb, quality, search, worklist


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def test_chunks(spark):
    body = "intro\n## [00:00:10] One\n" + "a" * 50 + "\n## [00:01:00]\nTitle below\n" + "b " * 30 + "\n## (00:01:30) no header\n## 02:00 Short\ntiny\n## [00:03:00] Last\n" + "c" * 40 + "\n### [00:04:00] no header\n"
    files = spark.createDataFrame([("EP-9", "---\nepisode_number: 12abc\ntitle: T\n---\n" + body), ("EP-10", "## no time\nx")], "episode_id string, text string")
    out = chunking.chunk_transcripts(files)
    assert rows(out, "id", "timestamp_start", "timestamp_end", "timestamp_start_seconds", "section_title") == [
        ("hub-ep012-ts000010", "00:00:10", "00:01:00", 10, "One"), ("hub-ep012-ts000100", "00:01:00", "02:00", 60, "Title below"), ("hub-ep012-ts000300", "00:03:00", None, 180, "Last"),
    ]
    sources = spark.createDataFrame([("EP-9", True), ("EP-10", True), ("EP-11", False)], "episode_id string, has_file boolean")
    assert rows(chunking.chunk_stats(sources, out)) == [(1, 1, 1, 3, 3.0)]


def test_repeated_and_long_sections(spark):
    text = "".join(f"## [00:01:00] Same\n{c * 45}\n" for c in "xyz") + "## [00:02:00] Long\n" + ("Una frase de prueba. " * 200)
    out = rows(chunking.chunk_transcripts(spark.createDataFrame([("EP-1", text)], "episode_id string, text string")), "id")
    assert out == [("hub-ep001-ts000100",), ("hub-ep001-ts000100-dup2",), ("hub-ep001-ts000100-dup3",), ("hub-ep001-ts000200-p1",), ("hub-ep001-ts000200-p2",)]


def test_summary_rows(spark):
    md = "---\ntemas:\n- Sueño Profundo\ninvitado: Ana\n---\n# Episodio 4: El sueño\n## Resumen del Episodio\n" + "texto " * 20 + "\n## Puntos Clave\n- **A** corto\n- **B** un punto bastante largo\n## Recursos\nnada"
    out = rows(kb.summary_rows(spark.createDataFrame([("EP-4", md)], "episode_id string, text string")))
    assert [r[0] for r in out] == ["hub-ep004-overview", "hub-ep004-tk1"] and all(r[1] == "sueno-profundo" and r[3] == "true" for r in out)
    assert out[0][2].startswith("Episodio 4 - El sueño (invitado: Ana). texto")


def test_upsert_twice_is_once(spark):
    target = spark.createDataFrame([(1, "a", True), (2, "b", True)], "id int, topic string, active boolean")
    updates = spark.createDataFrame([(2, "old", 1), (2, "new", 2), (3, None, 1)], "id int, topic string, n int")
    once = kb.upsert(target, updates, "id", "n")
    assert rows(once) == [(1, "a", True), (2, "new", True), (3, None, None)]
    assert rows(kb.upsert(once, updates, "id", "n")) == rows(once)


def test_dates_brands_lots(spark):
    dates = spark.createDataFrame([("001", "2021-01-04"), ("002", None)], "key string, date string")
    base = spark.createDataFrame([("hub-ep001-tk1", "", "t", "true"), ("hub-ep002-tk1", "x", "t", "true"), ("hub-ep009-tk1", "x", "t", "false"), ("", "x", "t", "true")], "id string, topic string, text string, active string")
    out = rows(kb.to_kb_rows(base, dates, "hub"), "id", "topic", "episode_date")
    assert [(a, b, str(c)) for a, b, c in out] == [("hub-ep001-tk1", "general", "2021-01-04"), ("hub-ep002-tk1", "x", "None")]
    brands = spark.createDataFrame([("b1", "t", True, True), ("b2", "t", False, False), ("b3", "u", True, False)], "id string, tenant_id string, active boolean, is_default boolean")
    asked = spark.createDataFrame([(1, "t", None), (2, "t", "b2"), (3, "t", "b3"), (4, "u", None), (5, "u", "b3")], "query_id int, tenant_id string, brand_id string")
    good, bad = kb.resolve_brand(asked, brands)
    assert rows(good, "query_id", "brand_id") == [(1, "b1"), (5, "b3")] and rows(bad, "query_id") == [(2,), (3,), (4,)]
    lot = spark.createDataFrame([(1, "x")], "id int, topic string")
    assert kb.remove_lot(lot, "x").count() == 0
    on = spark.createDataFrame([(1, True), (2, True)], "id int, active boolean")
    assert rows(kb.deactivate(on, spark.createDataFrame([(2,), (2,)], "id int"))) == [(1, True), (2, False)]


def test_catalog_and_compile(spark):
    paths = [("docs/Episodes/EP-001 - A - B/summary.md", 1), ("docs/Episodes/EP-001 - Late/transcript.md", 2), ("docs/Episodes/Plain/summary.md", 3), ("docs/Episodes/index.md", 4), ("other/EP/x/summary.md", 5)]
    out = catalog.episode_catalog(spark.createDataFrame(paths, "path string, n int"))
    assert rows(out, "id", "title", "has_summary", "has_transcript") == [("EP-001", "A - B", True, True), ("Plain", "Plain", True, False)]
    raw = spark.createDataFrame([("EP-001", "summary", "# EP-001 - En\nx")], "id string, kind string, text string")
    es = spark.createDataFrame([("EP-001", "transcript", "t")], "id string, kind string, text string")
    got = {r.id: r for r in catalog.compile_episodes(out, raw, es).collect()}
    assert (got["EP-001"].title_en, got["EP-001"].title_es, got["EP-001"].transcript_es, got["EP-001"].has_transcript) == ("En", "En", "t", False)
    assert got["Plain"].title_es == "Plain" and got["Plain"].summary_en == ""


def test_audit_thresholds(spark):
    src = "x" * 1000
    pairs = [(n, src, "y" * n) for n in (840, 850, 1400, 1410)]
    heads = "## a\n## b\n## c\n" + "z" * 100
    pairs += [(1, heads, "title: a\ntitle: b\n" + heads), (2, heads, "## a\n[00:00:01] b\n[00:00:02] c\n" + "z" * 90), (3, heads, "## a\nb b b b\nc c c c\n" + "z" * 95), (4, heads, "## a\n## b\nc c c c\n" + "z" * 95), (5, "", "")]
    paired = spark.createDataFrame(pairs, "episode_id int, source string, translation string")
    whole = quality.audit_translation(paired)
    out = {r.episode_id: (r.status, r.reason) for r in whole.collect()}
    assert out == {840: ("discarded", "truncated"), 850: ("ok", None), 1400: ("ok", None), 1410: ("discarded", "inflated"), 1: ("discarded", "ghost title"), 2: ("patched", None), 3: ("discarded", "missing headers"), 4: ("ok", None), 5: ("ok", None)}
    done = paired.select("episode_id", (F.col("episode_id") != 850).alias("transcript"))
    raw, es = paired.select("episode_id", F.col("source").alias("text")), paired.select("episode_id", F.when(F.col("episode_id") != 840, F.col("translation")).alias("text"))
    joined = quality.audit_done(done, raw, es)
    assert rows(joined) == rows(whole.filter("episode_id not in (840, 850)")) and {r.episode_id: r.text for r in joined.collect()}[2].startswith("## a\n## [00:00:01] b\n")
    plan = joined.drop("text")._sc._jvm.PythonSQLUtils.explainString(joined.drop("text")._jdf.queryExecution(), "formatted")
    moved = re.findall(r"\(\d+\) \w*Exchange\nInput \[\d+\]: (.*)", plan)
    assert moved and not [m for m in moved if "_text" in m or "translation" in m]


def test_pairs_and_ads(spark):
    progress = spark.createDataFrame([("a", True), ("b", True), ("c", False)], "episode_id string, transcript boolean")
    raw = spark.createDataFrame([("a", "x"), ("b", "y")], "episode_id string, text string")
    pairs, missing = quality.pair_docs(progress, raw, raw.filter("episode_id = 'a'"))
    assert rows(pairs) == [("a", "x", "x")] and rows(missing) == [("b", False, True)]
    seg = [(1, "transcript_segment", "Buy NOW  at x", 1), (2, "transcript_segment", "buy now at X", 2), (3, "transcript_segment", "sponsor " + "x" * 3000, 3), (4, "safe", "sponsor", 4), (5, "other", "sponsor", 5)]
    out = quality.flag_ads(spark.createDataFrame(seg, "id int, topic string, content string, episode_number int"), ["sponsor"], 2, 2000, ("safe",))
    assert rows(out, "id", "is_ad") == [(1, True), (2, True), (3, False), (4, False), (5, True)]


def test_worklist(spark):
    ids = spark.createDataFrame([(f"e{i:02d}", True) for i in range(11)], "episode_id string, has_transcript boolean").repartition(4)
    done = spark.createDataFrame([("e03", True), ("e04", False)], "episode_id string, transcript boolean")
    todo = worklist.pending(ids, done, "transcript")
    out = worklist.round_robin(todo, 2, "episode_id", 3)
    assert [r.idx for r in out.orderBy("episode_id").collect()] == list(range(10))
    assert rows(worklist.bucket_load(out)) == [(0, 5), (1, 5)]
    assert rows(worklist.pending(ids, done, "transcript", 2), "episode_id") == [("e00",), ("e01",)]
    assert worklist.select_known(spark.createDataFrame([("e01",), ("zz",)], "episode_id string"), ids).count() == 1


def test_keyword_search(spark):
    index = spark.createDataFrame([(1, "Dormir bien", "Sleep", "dormir", "x"), (2, "otra", "sleep el", "", None), (3, "nada", "none", "", "")], "id int, title_es string, title_en string, summary_es string, summary_en string")
    q = spark.createDataFrame([(9, "dormir sleep el dormir"), (8, "el")], "query_id int, query_text string")
    assert rows(search.keyword_search(index, q)) == [(9, 1, 46, 1), (9, 2, 10, 2)]


def test_citations(spark):
    df = spark.createDataFrame([(1, None, "abc"), (2, "00:01:02", None), (3, "00:01:02", "abc")], "episode_number int, timestamp_start string, video_id string")
    assert rows(citations.citation(df), "citation", "link") == [("[Episodio 1]", None), ("[Episodio 2 | 00:01:02]", None), ("[Episodio 3 | 00:01:02 → youtu.be/abc?t=62]", "youtu.be/abc?t=62")]
    files = spark.createDataFrame([("EP-1", '---\nyoutube_id: "H-XfCl-HpRM"\n---\n'), ("EP-2", "---\nyoutube_id: short\n---\n"), ("EP-3", "x")], "episode_id string, text string")
    assert rows(citations.video_map(files)) == [(1, "H-XfCl-HpRM")]
    assert rows(citations.video_stats(files)) == [("invalid", 1), ("missing", 1), ("ok", 1)]


@pytest.mark.parametrize("present", [True, False])
def test_stats_and_coverage(spark, present):
    df = spark.createDataFrame([("hub-ep001-tk1",), ("hub-ep001-overview",)] if present else [], "id string")
    assert rows(kb.kb_stats(df)) == ([(1, 1, 0, 1, 0, 0, 2)] if present else [(0, 0, 0, 0, 0, 0, 0)])
    episodes = spark.createDataFrame([(1,), (2,)], "episode_number int")
    assert rows(kb.coverage(episodes, spark.createDataFrame([(1,), (1,)], "episode_number int"))) == [(1, 1)]
