import numpy as np
import pytest
from pyspark.sql import functions as F

from lorebank.operators import citations, evaluate, hybrid, kb, lexical, search, vector


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    data = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(300)] + [(300, None), (301, [0.0] * 8)]
    data += [(302, data[5][1]), (303, data[5][1])]
    return spark.createDataFrame(data, "id int, embedding array<float>").repartition(6)


def exact(vectors, ids, k):
    data = {r.id: np.array(r.embedding, np.float64) for r in vectors.filter("embedding is not null").collect()}
    unit = {i: v / np.linalg.norm(v) for i, v in data.items() if np.linalg.norm(v)}
    out = []
    for q in ids:
        best = sorted(((-float(unit[q] @ v), i) for i, v in unit.items()), key=lambda x: (round(x[0], 12), x[1]))[:k]
        out += [(q, i, n + 1) for n, (_, i) in enumerate(best)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [2, 100])
def test_exact_vector_search(spark, vectors, block):
    queries = vectors.filter("id < 5").select(F.col("id").alias("query_id"), "embedding")
    assert rows(vector.cosine_topk(queries, vectors, 7, block), "query_id", "id", "rank") == exact(vectors, range(5), 7)
    assert vector.cosine_topk(queries.filter("false"), vectors, 7).count() == 0


def test_all_lists_probed_is_exact(spark, vectors):
    queries = vectors.filter("id < 5").select(F.col("id").alias("query_id"), "embedding")
    index = vector.ivf_build(vectors, lists=6)
    assert rows(vector.ivf_topk(queries, index, 7, probes=6), "query_id", "id", "rank") == exact(vectors, range(5), 7)
    near = vector.ivf_topk(queries, index, 7, probes=3)
    found = {(r.query_id, r.id) for r in near.collect()} & {(q, i) for q, i, _ in exact(vectors, range(5), 7)}
    assert len(found) >= 0.6 * 35


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 2.0], [2.0, 4.0]), ([1.0, 0.0], [0.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    assert [r.c if r.c is None else round(r.c, 9) for r in df.select(vector.cosine(F.col("a"), F.col("b")).alias("c")).collect()] == [1.0, 0.0, None]


def test_query_syntax(spark):  # the stop words are read through the session
    assert lexical.parsed_query('uno "dos tres" or cuatro -cinco -"seis siete"') == {"groups": [[["uno"], ["dos", "tres"]], [["cuatro"]]], "excluded": [["cinco"], ["seis", "siete"]]}
    assert lexical.parsed_query(None) == {"groups": [], "excluded": []} == lexical.parsed_query("or -")
    assert lexical.parsed_query("los gatos", "spanish")["groups"] == [[[lexical.stem("gato")]]]


def test_cover_density():
    at = lambda *p: np.array(p)
    assert lexical.cover_density([(at(1, 5, 9), 1)]) == pytest.approx(0.3)
    assert lexical.cover_density([(at(1), 1), (at(2), 1)]) == pytest.approx(0.1)
    assert lexical.cover_density([(at(1), 1), (at(5), 1)]) == pytest.approx(0.1 / 4)
    assert lexical.cover_density([(at(1, 4), 1), (at(2), 1)]) == pytest.approx(0.1 + 0.1 / 2)


def test_text_search(spark):
    docs = spark.createDataFrame([(1, "El gato negro duerme"), (2, "gato blanco y gato negro"), (3, "perro negro gato"), (4, None), (5, "")], "id int, content string")
    q = spark.createDataFrame([(1, "gato negro"), (2, '"gato negro"'), (3, "gato -perro"), (4, "perro or blanco"), (5, ""), (6, None), (7, "gato zzz")], "query_id int, query_text string")
    out = lexical.text_topk(q, lexical.term_table(docs))
    assert rows(out, "query_id", "id", "rank") == [(1, 1, 1), (1, 2, 2), (1, 3, 3), (2, 1, 1), (2, 2, 2), (3, 1, 2), (3, 2, 1), (4, 2, 1), (4, 3, 2)]
    es = lexical.text_topk(spark.createDataFrame([(1, "los gatos negros")], "query_id int, query_text string"), lexical.term_table(docs, "spanish"), config="spanish")
    assert {r.id for r in es.collect()} == {1, 2, 3}


def test_fusion(spark):
    v = spark.createDataFrame([(1, "a", 0.9, 1), (1, "b", 0.8, 2)], "query_id int, id string, similarity double, rank int")
    t = spark.createDataFrame([(1, "a", 3), (1, "c", 1)], "query_id int, id string, rank int")
    out = {r.id: (r.similarity, r.rank_score) for r in hybrid.rrf_fuse(v, t).collect()}
    assert out["a"] == (0.9, pytest.approx(1 / 51 + 1 / 53, abs=1e-12)) and out["c"] == (0.0, pytest.approx(1 / 51)) and out["b"] == (0.8, pytest.approx(1 / 52))
    swapped = {r.id: r.rank_score for r in hybrid.rrf_fuse(t.withColumn("similarity", F.lit(0.0)), v).collect()}
    assert swapped == {k: s for k, (_, s) in out.items()}


@pytest.mark.parametrize("count,want", [(None, 8), (0, 1), (25, 20), (5, 5)])
def test_clamp(spark, count, want):
    assert spark.range(1).select(hybrid.clamped(count).alias("n")).first().n == want


def test_hybrid_search_and_compat(spark):
    kb = spark.createDataFrame([(i, "t", None if i == 2 else "x", f"word{i % 3} text", [1.0, i / 10] if i % 4 else None, i, i != 7) for i in range(1, 12)], "id int, tenant_id string, topic string, content string, embedding array<float>, episode_number int, active boolean")
    terms = lexical.term_table(kb)
    q = spark.createDataFrame([(1, "word1", [1.0, 0.1])], "query_id int, query_text string, embedding array<float>")
    out = hybrid.hybrid_search(q, kb, terms, 20).collect()
    assert {r.id for r in out} == set(range(1, 12)) - {7, 8} and {r.topic for r in out if r.id == 2} == {"General"}
    assert [r.id for r in sorted(out, key=lambda r: r.pos)][0] == 1
    assert {r.topic for r in hybrid.search_named("hybrid")(q, kb, terms, match_count=20).collect() if r.id == 2} == {None}
    assert hybrid.search_named("nope") is hybrid.hybrid_search and hybrid.search_named(None) is hybrid.hybrid_search
    assert hybrid.vector_search(q, kb, match_count=2).count() == 2
    ranked = hybrid.rerank(hybrid.hybrid_search(q, kb, terms, 20), lambda b: b["episode_number"], 3)
    assert rows(ranked, "id", "rerank_pos") == [(10, 2), (11, 1), (9, 3)]


def test_slots(spark):
    df = spark.createDataFrame([(1, p, "ad" if p < 5 else "doc") for p in range(1, 8)], "query_id int, pos int, topic string")
    assert rows(hybrid.allocate_slots(df, 4, {"doc": 2}), "pos", "slot") == [(1, 1), (2, 2), (5, 3), (6, 4)]


def test_judgement_and_summary(spark):
    golden = spark.createDataFrame([("a", "specific", [5]), ("b", "vague", []), ("c", "offtopic", []), ("d", "specific", [1, 2]), ("e", "specific", [3])], "query_id string, type string, expected array<int>")
    got = spark.createDataFrame([("a", 1, None, 0.0), ("a", 2, 7, 0.5), ("a", 3, 5, 0.4), ("c", 1, 9, 0.2), ("d", 1, 2, 0.9), ("e", 1, 4, 0.1)], "query_id string, pos int, episode int, similarity double")
    judged = evaluate.judge(golden, got)
    assert rows(judged, "query_id", "hit", "rank", "top_score") == [("a", True, 2, 0.0), ("b", None, None, 0.0), ("c", None, None, 0.2), ("d", True, 1, 0.9), ("e", False, None, 0.1)]
    assert rows(evaluate.eval_summary(judged), "*") == [(4, 2, 0.5, 0.375, 0.2)]
    assert rows(evaluate.eval_summary(judged, True), "*") == [(3, 2, 0.667, 0.5, 0.2)]
    assert rows(evaluate.eval_by_type(judged), "type", "evaluable", "hits") == [("all", 4, 2), ("offtopic", 0, 0), ("specific", 3, 2), ("vague", 1, 0)]
    assert rows(evaluate.rank_histogram(judged), "*") == [(1, 1), (2, 1)]


def test_ranks_of_a_published_run(spark):
    ranks = [1] * 12 + [2] + [3] * 2 + [4] * 2 + [5, 6]
    data = [(str(i), "specific", True, r, 0.5, True) for i, r in enumerate(ranks)] + [(f"m{i}", "specific", False, None, 0.4, True) for i in range(14)]
    out = evaluate.eval_summary(spark.createDataFrame(data, "query_id string, type string, hit boolean, rank int, top_score double, answerable boolean")).first()
    assert (out.evaluable, out.hits, out.recall, out.mrr) == (33, 19, 0.576, 0.425)


def test_precision_keywords_runs(spark):
    got = spark.createDataFrame([(1, p, p) for p in range(1, 7)], "query_id int, pos int, id int")
    flags = spark.createDataFrame([(1, True), (2, True), (3, False)], "id int, is_ad boolean")
    assert evaluate.context_precision(got, flags, 6).first().precision == pytest.approx(4 / 6)
    asked = spark.createDataFrame([(1, ["Sueño", "luz"]), (2, ["x"])], "query_id int, keywords array<string>")
    ctx = spark.createDataFrame([(1, "el SUEÑO")], "query_id int, context string")
    assert rows(evaluate.keyword_coverage(asked, ctx), "query_id", "found", "share") == [(1, 1, 0.5), (2, 0, 0.0)]
    odd = spark.createDataFrame([(1, ["a", "A", "", None, "ab", "zz"]), (2, []), (3, None)], "query_id int, keywords array<string>")
    ctx = spark.createDataFrame([(1, "xAb"), (2, "y")], "query_id int, context string")
    assert rows(evaluate.keyword_coverage(odd, ctx), "query_id", "found", "expected", "share") == [(1, 4, 6, 4 / 6), (2, 0, 0, None), (3, None, None, None)]
    other = got.withColumn("id", F.when(F.col("pos") == 2, 99).otherwise(F.col("id"))).filter("pos < 6")
    assert rows(evaluate.diff_runs(got, other), "pos", "id_a", "id_b") == [(2, 2, 99), (6, 6, None)]
    assert rows(evaluate.same_runs(got, other), "*") == [(2, 1, 4)]
    sims = got.withColumn("similarity", F.col("pos") / 10)
    assert citations.answer_confidence(sims).first().confidence == pytest.approx(0.6)
    assert citations.build_context(got.withColumn("content", F.col("id").cast("string")), 2).first().context == "1\n\n2"


@pytest.fixture(scope="module")
def tenants(spark):
    data = [(i, "ab"[i % 2], f"b{i % 3}", f"gato {'negro' if i % 4 else 'blanco'}", [1.0, i / 10] if i % 5 else None, True) for i in range(40)]
    kb = spark.createDataFrame(data, "id int, tenant_id string, brand_id string, content string, embedding array<float>, active boolean")
    brands = spark.createDataFrame([("b0", "a", True, True), ("b1", "a", True, False), ("b2", "a", False, False), ("b1", "b", True, False)], "id string, tenant_id string, active boolean, is_default boolean")
    return kb, brands


@pytest.mark.parametrize("search", [hybrid.hybrid_search, hybrid.vector_search])
def test_each_query_has_its_tenant_and_brand(spark, tenants, search):
    kb, brands = tenants
    asked = [(1, "a", None), (2, "a", "b1"), (3, "b", "b1"), (4, "b", None), (5, "a", "b2"), (6, None, "b1"), (7, "b", "b0")]
    queries = spark.createDataFrame([(i, "gato", [1.0, 0.5], t, b) for i, t, b in asked], "query_id int, query_text string, embedding array<float>, tenant_id string, brand_id string")
    found = search(queries, kb, lexical.token_rows(kb), match_count=20, brands=brands).join(kb.select("id", "tenant_id", "brand_id"), "id")
    seen = {}
    for r in found.collect():
        seen.setdefault(r.query_id, set()).add((r.tenant_id, r.brand_id))
    assert seen == {1: {("a", "b0")}, 2: {("a", "b1")}, 3: {("b", "b1")}}  # no default brand, inactive, no tenant, brand of another tenant
    by_tenant = search(queries, kb, lexical.token_rows(kb), match_count=20).join(kb.select("id", "tenant_id"), "id")
    assert {(r.query_id, r.tenant_id) for r in by_tenant.collect()} == {(1, "a"), (2, "a"), (3, "b"), (4, "b"), (5, "a"), (7, "b")}


def test_rows_without_a_vector_take_the_last_ranks_of_legacy_search(spark, tenants):
    kb, _ = tenants
    q = spark.createDataFrame([(1, "zzz", [1.0, 0.5])], "query_id int, query_text string, embedding array<float>")
    out = sorted(hybrid.legacy_hybrid(q, kb, lexical.token_rows(kb), match_count=40).collect(), key=lambda r: r.pos)
    assert [r.id for r in out[-8:]] == list(range(0, 40, 5)) and all(r.similarity == 0 for r in out[-8:])
    assert [round(1 / r.rank_score) for r in out] == list(range(51, 91))
    single = hybrid.one_query(hybrid.legacy_hybrid, "zzz", [1.0, 0.5], kb, lexical.token_rows(kb), match_count=40).collect()
    assert [r.id for r in single] == [r.id for r in out]
    assert [r.tenant_id for r in hybrid.one_query(hybrid.vector_search, None, [1, 0], kb, tenant="b").join(kb.select("id", "tenant_id"), "id").collect()] == ["b"] * 3


@pytest.mark.parametrize("block", [2, 1000])
def test_keyword_search_matches_a_plain_loop(spark, block):
    rng = np.random.default_rng(2)
    words = ["sueño", "luz", "luces", "ejercicio", "Ejercicios", "a", "de", "café"]
    text = lambda n: " ".join(rng.choice(words, n))
    index = [(i, text(2), text(3), None if i == 3 else text(9), text(5)) for i in range(60)]
    queries = [(i, text(4)) for i in range(9)] + [(20, "a de"), (21, None), (22, "luz luz")]
    want = []
    for q, t in queries:
        ws = [w for w in (t or "").lower().split() if len(w) > 2]
        scores = [(-sum(p * (w in (f or "").lower()) for w in ws for p, f in zip((10, 15, 2, 3), row[1:])), row[0]) for row in index]
        want += [(q, i, -s, n + 1) for n, (s, i) in enumerate(sorted(x for x in scores if x[0])[:5])]
    got = search.keyword_search(spark.createDataFrame(index, "id int, title_en string, title_es string, summary_en string, summary_es string").repartition(4), spark.createDataFrame(queries, "query_id int, query_text string"), block=block)
    assert rows(got, "query_id", "id", "score", "pos") == sorted(want, key=str)


def test_equal_queries_and_phrases_match_a_plain_rank(spark):
    rng = np.random.default_rng(4)
    docs = [(i, " ".join(rng.choice(["uno", "dos", "tres", "or", "x"], 30))) for i in range(30)]
    asked = ["uno", "uno", "uno uno", '"uno dos"', "uno dos tres", "uno or tres", "uno -tres", 'dos "tres uno" -"x x"', "zzz", "or"]
    got = lexical.text_topk(spark.createDataFrame(list(enumerate(asked)), "query_id int, query_text string"), lexical.token_rows(spark.createDataFrame(docs, "id int, content string")), 50)
    want = []
    for q, t in enumerate(asked):
        p = lexical.parsed_query(t)
        scores = []
        for i, text in docs:
            held = {}
            for at, w in enumerate(text.split(), 1):
                held.setdefault(w, []).append(at)
            s = lexical._rank(p["groups"], p["excluded"], list(held), list(held.values()))
            if s is not None:
                scores.append((-round(s, 9), i))
        want += [(q, i, n + 1) for n, (_, i) in enumerate(sorted(scores))]
    assert rows(got.withColumn("text_rank", F.round("text_rank", 9)), "query_id", "id") == sorted([(q, i) for q, i, _ in want], key=str)
    assert {r.rank for r in got.filter("query_id = 0").collect()} == set(range(1, 1 + sum(q == 0 for q, *_ in want)))


def test_vector_search_within_scopes_equals_a_plain_loop(spark):
    rng = np.random.default_rng(3)
    scopes = ["a", "b", None, "only rows", "c"]
    kb_rows = [(i, rng.normal(size=4).round(1).tolist(), scopes[i % 4]) for i in range(300)]
    asked = [(i, rng.normal(size=4).round(1).tolist(), scopes[(0, 1, 2, 4)[i % 4]]) for i in range(40)]
    kb_df = spark.createDataFrame(kb_rows, "id int, embedding array<float>, scope string").repartition(3)
    q = spark.createDataFrame(asked, "query_id int, embedding array<float>, scope string")
    got = rows(vector.cosine_topk(q, kb_df, 5, block=16, scope="scope"), "query_id", "rank", "id")

    def cosine(x, y):
        x, y = np.float32(x).astype(float), np.float32(y).astype(float)
        return round(float(x @ y / (np.linalg.norm(x) * np.linalg.norm(y))), 12)

    want = [(n, r + 1, i) for n, x, own in asked for r, (_, i) in enumerate(sorted((-cosine(x, y), i) for i, y, there in kb_rows if there == own)[:5])]
    assert sorted(got) == sorted(want)


def test_tables_are_small_by_rows_and_bytes(spark):
    wide = spark.range(10).select("id", F.array(F.repeat(F.lit("x"), 1000)).alias("terms"))
    assert kb.is_small(wide) and not kb.is_small(wide, rows=9) and not kb.is_small(wide, size=10_000) and kb.is_small(wide.select("id"), size=160)
    assert kb.is_small(wide.filter("id < 0"), rows=0, size=0)


def test_lists_are_multiplied_and_not_joined(spark):
    """Pairs of query and row are no rows of a table; equal vectors, dealt over all tasks and places, tie to the bit and go by id."""
    rng = np.random.default_rng(5)
    one = [float(x) for x in rng.normal(size=64).astype(np.float32)]
    kb = spark.createDataFrame([(i, one if i % 3 == 0 else [float(x) for x in rng.normal(size=64)]) for i in range(900)] + [(900, None), (901, [0.0] * 64)], "id int, embedding array<float>").repartition(5)
    queries = kb.filter("id < 40 or id >= 900").select(F.col("id").alias("query_id"), "embedding")
    index = vector.ivf_build(kb, lists=9)
    out = vector.ivf_topk(queries, index, 8, probes=9, block=15)
    assert "Join" not in out._jdf.queryExecution().toString() and out.columns == ["query_id", "id", "similarity", "rank"]
    assert rows(out, "query_id", "id", "rank") == exact(kb, range(40), 8)
    assert {(r.id, r["rank"]) for r in out.filter("query_id = 0").collect()} == {(3 * i, i + 1) for i in range(8)}
    pairs = out.join(queries.withColumnRenamed("embedding", "q"), "query_id").join(kb, "id")
    assert pairs.filter(F.col("similarity") != vector.cosine(F.col("q"), F.col("embedding"))).count() == 0
    few = vector.ivf_topk(queries, index, 1000, probes=2)
    assert few.groupBy("query_id").count().agg(F.max("count")).first()[0] < 900
    assert vector.ivf_topk(queries.filter("false"), index, 8).count() == 0 == vector.ivf_topk(kb.filter("id > 900").select(F.col("id").alias("query_id"), "embedding"), index, 8).count()


def test_recall_of_the_registered_query(spark, tmp_path, monkeypatch):
    """Against its SQL's numbers, with many equal vectors; neither search makes a row for each pair of query and row."""
    from lorebank.jobs import queries

    rng = np.random.default_rng(6)
    same = [float(x) for x in rng.normal(size=16)]
    data = [(i, same if i % 4 == 0 else [float(x) for x in rng.normal(size=16)], 0) for i in range(600)]
    spark.createDataFrame(data, "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame([(i, f"w{i}", "es", "src1") for i in range(600)], "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.ivf_recall(spark, str(tmp_path))
    assert tuple(out.first()) == (30, 300, True)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1  # of the exact rows with the found ones
