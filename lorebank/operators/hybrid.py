"""Hybrid search: vector and text candidates fused by reciprocal rank, cut, then hydrated."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lorebank.functions.text import default_topic, rrf
from lorebank.operators.kb import BROADCAST_ROWS, resolve_brand, visible
from lorebank.operators.lexical import text_topk
from lorebank.operators.textindex import TextIndex, indexed_topk
from lorebank.operators.vector import cosine_topk

#: Candidates of each side, and bounds of the number of results.
CANDIDATES, LEAST, MOST, DEFAULT_COUNT = 50, 1, 20, 8

#: Columns of the knowledge base that results carry.
CARRIED = ["topic", "content", "episode_number", "episode_date", "timestamp_start", "timestamp_end"]


def clamped(count: Column | int | None) -> Column:
    """A number of results within its bounds; null gives the default."""
    c = count if isinstance(count, Column) else F.lit(count).cast("int")
    return F.least(F.lit(MOST), F.greatest(F.lit(LEAST), F.coalesce(c, F.lit(DEFAULT_COUNT))))


def rrf_fuse(vectors: DataFrame, texts: DataFrame, k: int = 50) -> DataFrame:
    """query_id, id, similarity (0 where only the text matched), rank_score. Inputs: query_id, id, rank (and similarity)."""
    v = vectors.select("query_id", "id", "similarity", F.col("rank").alias("vec_rank"))
    t = texts.select("query_id", "id", F.col("rank").alias("text_rank"))
    return v.join(t, ["query_id", "id"], "full").select(
        "query_id", "id", F.coalesce("similarity", F.lit(0.0)).alias("similarity"), (rrf(F.col("vec_rank"), k) + rrf(F.col("text_rank"), k)).alias("rank_score")
    )


def hydrate(fused: DataFrame, kb: DataFrame, at_most: int | None = None) -> DataFrame:
    """Document columns of the results. ``at_most``: how many results there can be; few ones are broadcast."""
    there = [c for c in CARRIED if c in kb.columns]
    return kb.select("id", *there).join(F.broadcast(fused) if at_most is not None and at_most <= BROADCAST_ROWS else fused, "id")


def best_first(df: DataFrame, count: Column | int | None) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("rank_score"), F.desc("similarity"), "id")
    return df.withColumn("pos", F.row_number().over(order)).filter(F.col("pos") <= count)


def _scope(by_brand: bool) -> Column:
    """Tenant and brand as one text; null where either is."""
    return F.concat("tenant_id", F.lit("\u0001"), "brand_id") if by_brand else F.col("tenant_id")


def scoped(queries: DataFrame, kb: DataFrame, brands: DataFrame | None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Queries and rows with a column ``scope``, and the rejected queries.

    Queries with a ``tenant_id`` find rows of their tenant, and with ``brands`` of their own brand or else the
    tenant's default one; those without an active brand of their tenant are rejected. Other queries find all rows."""
    if "tenant_id" not in queries.columns:
        return queries, kb, None
    if brands is None:
        return queries.withColumn("scope", _scope(False)).filter("scope is not null"), kb.withColumn("scope", _scope(False)), None
    asked = queries if "brand_id" in queries.columns else queries.withColumn("brand_id", F.lit(None).cast("string"))
    good, bad = resolve_brand(asked, brands)
    return good.withColumn("scope", _scope(True)), kb.withColumn("scope", _scope(True)), bad


def _texts(queries: DataFrame, seen: DataFrame, terms: DataFrame | TextIndex, config: str, scope: str | None, narrow: bool) -> DataFrame:
    """Candidates of the text side, from a stored index or from rows of tokens."""
    rows = seen.select("id", *([scope] if scope else []))
    if isinstance(terms, TextIndex):
        return indexed_topk(queries, terms, CANDIDATES, rows if narrow or (scope and not terms.scoped) else None)
    return text_topk(queries, terms, CANDIDATES, config, rows)


def hybrid_search(queries: DataFrame, kb: DataFrame, doc_terms: DataFrame | TextIndex, match_count: int | None = DEFAULT_COUNT, rrf_k: int = 50, brands: DataFrame | None = None, tenant: str | None = None, brand: str | None = None, config: str = "plain", compat: str = "v1") -> DataFrame:
    """Results of each query: pos, id, similarity, rank_score and the document's columns.

    queries: query_id, query_text, embedding, and for searches within tenants tenant_id and brand_id (see
    ``scoped``; a null brand is the tenant's default one, rejected queries find nothing). doc_terms: a term table,
    rows of tokens, or a stored index, which holds the active rows and has its own ``config``. ``tenant`` and ``brand`` narrow all queries alike. ``compat="v0"``: no brand, no clamp, no
    topic default, and rows without a vector rank after all others. Both sides are cut to their candidates, the
    fusion to its results, before documents are read."""
    old = compat == "v0"
    asked, rows, _ = scoped(queries, kb, None if old else brands)
    seen = visible(rows, tenant, None if old else brand)
    scope = "scope" if "scope" in asked.columns else None
    vectors = cosine_topk(asked, seen, CANDIDATES, scope=scope)
    if old:
        vectors = with_null_vectors(vectors, asked, seen, CANDIDATES, scope)
    texts = _texts(asked, seen, doc_terms, config, scope, tenant is not None or brand is not None)
    count = F.lit(match_count) if old else clamped(match_count)
    out = hydrate(best_first(rrf_fuse(vectors, texts, rrf_k), count), seen, queries.count() * max(MOST, match_count or 0))
    return out if old or "topic" not in out.columns else out.withColumn("topic", default_topic(F.col("topic"), "General", only_null=True))


def with_null_vectors(found: DataFrame, queries: DataFrame, kb: DataFrame, k: int, scope: str | None = None) -> DataFrame:
    """Ranks of vector search where rows without a vector follow all others, by id, without a similarity.

    They show only where fewer than ``k`` rows (of the scope) have a vector; no more than k of each scope are needed."""
    by = [scope] if scope else []
    own = F.row_number().over(Window.partitionBy(*(by or [F.lit(0)])).orderBy("id"))
    # The k smallest ids of each partition come first, so that no task sees all rows of a scope.
    part = F.row_number().over(Window.partitionBy(*by, F.spark_partition_id()).orderBy("id"))
    bare = kb.filter(F.col("embedding").isNull()).select("id", *by).withColumn("_part", part).filter(F.col("_part") <= k).withColumn("_n", own).filter(F.col("_n") <= k).drop("_part")
    have = queries.filter(F.col("embedding").isNotNull()).select("query_id", *by).join(found.groupBy("query_id").agg(F.count(F.lit(1)).alias("_have")), "query_id", "left")
    short = have.withColumn("_have", F.coalesce("_have", F.lit(0))).filter(F.col("_have") < k)
    more = short.join(bare, by) if by else short.join(F.broadcast(bare))  # at most k rows
    last = more.withColumn("rank", (F.col("_have") + F.col("_n")).cast("int")).filter(F.col("rank") <= k)
    return found.unionByName(last.select("query_id", "id", F.lit(None).cast("double").alias("similarity"), "rank"))


def vector_search(queries: DataFrame, kb: DataFrame, doc_terms: DataFrame | None = None, match_count: int | None = 3, brands: DataFrame | None = None, tenant: str | None = None, brand: str | None = None, **_) -> DataFrame:
    asked, rows, _rejected = scoped(queries, kb, brands)
    scope = "scope" if "scope" in asked.columns else None
    found = cosine_topk(asked, visible(rows, tenant, brand, need_vector=True), match_count or 3, scope=scope)
    return hydrate(found.select("query_id", "id", "similarity", F.col("similarity").alias("rank_score"), F.col("rank").alias("pos")), kb, queries.count() * (match_count or 3))


def legacy_hybrid(queries: DataFrame, kb: DataFrame, doc_terms: DataFrame, **options) -> DataFrame:
    return hybrid_search(queries, kb, doc_terms, compat="v0", **options)


def one_query(search: Callable[..., DataFrame], text: str | None, embedding: list[float], kb: DataFrame, doc_terms: DataFrame | None = None, tenant: str | None = None, brand: str | None = None, **options) -> DataFrame:
    """A search function for a single question, best result first."""
    row = {"query_id": 1, "query_text": text, "embedding": [float(x) for x in embedding]}
    kinds = "query_id int, query_text string, embedding array<float>"
    if tenant is not None:
        row, kinds = row | {"tenant_id": tenant, "brand_id": brand}, kinds + ", tenant_id string, brand_id string"
    asked = kb.sparkSession.createDataFrame([tuple(row.values())], kinds)
    return search(asked, kb, doc_terms, **options).orderBy("pos")


#: Search functions by name.
SEARCHES: dict[str, Callable[..., DataFrame]] = {"production": hybrid_search, "hybrid": legacy_hybrid, "vector": vector_search}


def search_named(mode: str | None) -> Callable[..., DataFrame]:
    """The search of that name; any other name gives the production one."""
    return SEARCHES.get(mode or "", hybrid_search)


def allocate_slots(ranked: DataFrame, k: int, min_per_type: dict[str, int], kind: str = "topic") -> DataFrame:
    """The k best of each query, with so many of each type guaranteed first. ranked: query_id, pos and the type."""
    place = F.row_number().over(Window.partitionBy("query_id", kind).orderBy("pos"))
    due = F.coalesce(F.create_map(*[F.lit(x) for p in min_per_type.items() for x in p])[F.col(kind)], F.lit(0)) if min_per_type else F.lit(0)
    first = ranked.withColumn("_due", (place <= due).cast("int"))
    kept = first.withColumn("_n", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("_due"), "pos"))).filter(F.col("_n") <= k)
    return kept.withColumn("slot", F.row_number().over(Window.partitionBy("query_id").orderBy("pos"))).drop("_due", "_n")


def rerank(candidates: DataFrame, scorer: Callable[[pd.DataFrame], pd.Series], k: int) -> DataFrame:
    """The k best of each query by a user's scorer over pandas batches; ties by id."""
    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(rerank_score=scorer(b).astype(float))

    out = candidates.mapInPandas(scored, T.StructType([*candidates.schema.fields, T.StructField("rerank_score", T.DoubleType())]))
    order = Window.partitionBy("query_id").orderBy(F.desc("rerank_score"), "id")
    return out.withColumn("rerank_pos", F.row_number().over(order)).filter(F.col("rerank_pos") <= k)
