"""Registered queries that write the given tables in the library's file formats and read them again, and their DuckDB SQL."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorebank.jobs.tables import brand_table, kb_table, query_table, table, transcripts, translations
from lorebank.operators import chunking, hybrid, kb, quality, worklist
from lorebank.sources import io


@cache
def _own_folder() -> str:
    made = tempfile.mkdtemp(prefix="lorebank-files-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    return f"file://{made}"


def scratch(spark: SparkSession) -> str:
    """A new path in spark.checkpoint.dir; where that is unset, in a folder of our own, in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{named or _own_folder()}/files-{uuid.uuid4().hex}"


def kb_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    io.write_kb_csv(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("topic"), "text", F.lit("true").alias("active")), path)
    return kb.active_rows(io.read_kb_csv(spark, path)).select("id", "topic", F.md5(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " ")).alias("text_md5"))


KB_CSV = r"SELECT doc_id::VARCHAR AS id, lang AS topic, md5(regexp_replace(trim(regexp_replace(coalesce(text, ''), '\r?\n', ' ', 'g')), '[\t\n\v\f\r ]+', ' ', 'g')) AS text_md5 FROM documents"


def keyed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON object for each source and language, with a member for each document."""
    path, docs = scratch(spark), table(spark, sf_dir, "documents")
    member = F.struct(F.col("doc_id").cast("string"), F.col("n_chars").cast("string"))
    docs.groupBy("source", "lang").agg(F.to_json(F.map_from_entries(F.collect_list(member))).alias("value")).repartition("source", "lang").write.partitionBy("source", "lang").text(path)
    return io.read_keyed_json(spark, path, "string").select("key", "value")


KEYED_JSON = "SELECT doc_id::VARCHAR AS key, n_chars::VARCHAR AS value FROM documents"


def chunk_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, chunks = scratch(spark), chunking.chunk_transcripts(transcripts(spark, sf_dir)).select("id", "episode_number", "timestamp_start", "section_title", "content")
    io.write_chunks(chunks, path)
    return io.read_chunks(spark, path, chunks.schema).select("id", "episode_number", "timestamp_start", "section_title", F.length("content").cast("long").alias("chars"))


def golden_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the benchmark as golden questions, a file for each of four parts."""
    path = scratch(spark)
    items = table(spark, sf_dir, "benchmark").withColumn("part", F.col("item_id") % 4)
    q = F.struct(
        F.col("item_id").cast("string").alias("id"), F.when(F.col("item_id") % 3 == 0, "vague").otherwise("specific").alias("type"), F.col("text").alias("question"),
        F.when(F.col("item_id") % 2 == 0, F.array(F.col("item_id").cast("int"))).alias("expected_episodes"),
    )
    items.groupBy("part").agg(F.collect_list(q).alias("questions")).repartition("part").write.partitionBy("part").json(path)
    return io.read_golden(spark, path).select("query_id", "type", F.md5("question").alias("question_md5"), F.array_join(F.col("expected").cast("array<string>"), ",").alias("expected"))


GOLDEN_FILES = "SELECT item_id::VARCHAR AS query_id, CASE WHEN item_id % 3 = 0 THEN 'vague' ELSE 'specific' END AS type, md5(text) AS question_md5, CASE WHEN item_id % 2 = 0 THEN item_id::VARCHAR ELSE '' END AS expected FROM benchmark"


def embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embedding hook, with the length of a text and its number of lines for a vector."""
    rows = io.embed(table(spark, sf_dir, "documents").select("doc_id", "text").na.fill(""), "text", lambda texts: [[float(len(t)), float(t.count("\n"))] for t in texts])
    return rows.select("doc_id", F.col("embedding")[0].cast("double").alias("first"), F.col("embedding")[1].cast("double").alias("second"))


EMBEDDED = "SELECT doc_id, length(coalesce(text, ''))::DOUBLE AS first, (length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')))::DOUBLE AS second FROM documents"


def layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    a = docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("topic"), F.col("n_chars").cast("long").alias("size"))
    b = pages.select(F.length("html").cast("long").alias("size"), F.lit("page").alias("topic"), F.col("page_id").alias("id"))
    return kb.union_kb(a, b, a.filter("id % 7 = 0").select("topic", "size", "id"))


LAYERS = """
SELECT doc_id AS id, lang AS topic, n_chars AS size FROM documents UNION ALL SELECT page_id, 'page', length(html) FROM pages UNION ALL SELECT doc_id, lang, n_chars FROM documents WHERE doc_id % 7 = 0
"""


def named_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "pages").select((F.col("page_id") * 3).alias("episode_id"))
    return worklist.select_known(asked, table(spark, sf_dir, "documents").select(F.col("doc_id").alias("episode_id")))


NAMED_IDS = "SELECT page_id * 3 AS episode_id FROM pages WHERE page_id * 3 IN (SELECT doc_id FROM documents)"


def first_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first fifty sources that are not done: the limit is the feature."""
    sources = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("episode_id"), (F.col("lang") != "en").alias("has_transcript"))
    done = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("episode_id"), (F.col("quality") == 1).alias("transcript"))
    return worklist.pending(sources, done, "transcript", limit=50).select("episode_id")


FIRST_PENDING = "SELECT doc_id AS episode_id FROM documents WHERE lang <> 'en' AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1) ORDER BY 1 LIMIT 50"


def missing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents marked done of which the source or the translation is missing."""
    raw, done = translations(spark, sf_dir)
    progress = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("episode_id"), (F.col("doc_id") % 6 != 5).alias("transcript"))
    return quality.pair_docs(progress, raw.filter("episode_id % 4 <> 0"), done.filter("episode_id % 3 <> 0"))[1]


MISSING_FILES = "SELECT doc_id AS episode_id, doc_id % 4 = 0 OR text IS NULL AS no_source, doc_id % 3 = 0 OR text IS NULL AS no_translation FROM documents WHERE doc_id % 6 <> 5 AND (doc_id % 4 = 0 OR doc_id % 3 = 0 OR text IS NULL)"


def pending_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is to be translated after an audit: sources never done, and those whose translation is discarded."""
    raw, done = translations(spark, sf_dir)
    progress = raw.select("episode_id", (F.col("episode_id") % 6 != 5).alias("transcript"))
    audit = quality.audit_done(progress, raw, done)
    return worklist.pending(raw.select("episode_id", F.lit(True).alias("has_transcript")), quality.progress_after(progress, audit), "transcript").select("episode_id")


#: Translations cut or doubled (doc_id % 5 of 1 and 2) are discarded.
PENDING_AGAIN = "SELECT doc_id AS episode_id FROM documents WHERE text IS NOT NULL AND (doc_id % 6 = 5 OR doc_id % 5 IN (1, 2))"


def visible_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kb.visible(kb_table(spark, sf_dir), "en", "src1", need_vector=True).select("id", "topic")


VISIBLE_ROWS = """
SELECT d.doc_id AS id, CASE WHEN d.doc_id % 9 <> 0 THEN 'topic' || (d.doc_id % 5) END AS topic FROM documents d JOIN embeddings ON doc_id = vec_id LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE lang = 'en' AND source = 'src1' AND coalesce(l.toxic, 0) <> 1
"""


def vector_tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search named ``vector``: the three nearest rows of each query's tenant and brand."""
    out = hybrid.search_named("vector")(query_table(spark, sf_dir), kb_table(spark, sf_dir), None, brands=brand_table(spark, sf_dir))
    return out.select("query_id", "pos", "id", F.round("similarity", 6).alias("similarity"))


VECTOR_TENANTS = """
WITH brands AS (SELECT DISTINCT lang, source FROM documents WHERE substr(source, 4)::INT % 3 <> 0),
kb AS (SELECT d.doc_id AS id, lang, source, embedding FROM documents d JOIN embeddings ON doc_id = vec_id LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE coalesce(l.toxic, 0) <> 1),
q AS (SELECT vec_id AS query_id, e.embedding, lang, CASE WHEN vec_id % 40 = 0 THEN source ELSE 'src1' END AS source FROM embeddings e JOIN documents ON doc_id = vec_id WHERE vec_id % 20 = 0),
s AS (SELECT query_id, id, list_cosine_similarity(q.embedding::DOUBLE[], kb.embedding::DOUBLE[]) AS s FROM q JOIN brands USING (lang, source) JOIN kb USING (lang, source))
SELECT query_id, pos, id, round(s, 6) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS pos FROM s) WHERE pos <= 3
"""

QUERIES = {
    "kb_csv": kb_csv, "keyed_json": keyed_json, "chunk_files": chunk_files, "golden_files": golden_files, "embedded": embedded, "layers": layers, "named_ids": named_ids, "first_pending": first_pending,
    "missing_files": missing_files, "pending_again": pending_again, "visible_rows": visible_rows, "vector_tenants": vector_tenants,
}

ORACLE_SQL = {
    "kb_csv": KB_CSV, "keyed_json": KEYED_JSON, "golden_files": GOLDEN_FILES, "embedded": EMBEDDED, "layers": LAYERS, "named_ids": NAMED_IDS, "first_pending": FIRST_PENDING,
    "missing_files": MISSING_FILES, "pending_again": PENDING_AGAIN, "visible_rows": VISIBLE_ROWS, "vector_tenants": VECTOR_TENANTS,
}
