"""The library's tables, shaped by Spark from the given ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A table of fewer partitions than cores (few files, or one row group), dealt over all of them before costly work on its rows.

    A table of many files is left as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def source_number(name: str = "source"):
    return F.regexp_extract(name, r"(\d+)", 1).try_cast("int")


def kb_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as rows of the knowledge base: language is the tenant, source the brand and the episode; toxic ones are inactive."""
    docs = table(spark, sf_dir, "documents")
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding", "label")
    toxic = table(spark, sf_dir, "labels").select("doc_id", (F.col("toxic") == 1).alias("toxic"))
    return (
        docs.join(vectors, "doc_id", "left").join(toxic, "doc_id", "left").select(
            F.col("doc_id").alias("id"), F.col("lang").alias("tenant_id"), F.col("source").alias("brand_id"),
            F.when(F.col("doc_id") % 9 != 0, F.concat(F.lit("topic"), (F.col("doc_id") % 5).cast("string"))).alias("topic"),
            F.col("text").alias("content"), "embedding", source_number().alias("episode_number"),
            F.when(F.col("doc_id") % 3 == 0, F.format_string("00:%02d:%02d", (F.col("doc_id") % 60).cast("int"), (F.col("doc_id") % 59).cast("int"))).alias("timestamp_start"),
            (~F.coalesce("toxic", F.lit(False))).alias("active"), "label",
        )
    )


def query_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query for every vector whose id is divisible by 20: its vector, and tenant, brand (of each second one) and first word of the document of that id."""
    word = F.regexp_extract(F.lower("text"), r"([\p{L}\p{N}_]+)", 1)
    docs = table(spark, sf_dir, "documents").filter(F.col("doc_id") % 20 == 0).select(F.col("doc_id").alias("vec_id"), word.alias("word"), "lang", "source")
    rows = table(spark, sf_dir, "embeddings").filter(F.col("vec_id") % 20 == 0).join(docs, "vec_id", "left")
    return rows.select(
        F.col("vec_id").alias("query_id"), F.coalesce("word", F.lit("")).alias("query_text"), "embedding", "label", F.col("lang").alias("tenant_id"), F.when(F.col("vec_id") % 40 == 0, F.col("source")).alias("brand_id")
    )


def brand_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages as tenants, their sources as brands: every third number is not active, src1 is the default."""
    pairs = table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    return pairs.select(F.col("source").alias("id"), F.col("lang").alias("tenant_id"), (source_number() % 3 != 0).alias("active"), (F.col("source") == "src1").alias("is_default"))


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as transcripts: a ``## [hh:mm:ss] role`` section a turn, 90 seconds apart; in each third one two turns share a time."""
    turns = table(spark, sf_dir, "conversations")
    sec = F.when(F.col("conv_id") % 3 == 0, F.floor(F.col("turn") / 2)).otherwise(F.col("turn")).cast("int") * 90
    stamp = F.format_string("%02d:%02d:%02d", (sec / 3600).cast("int"), (sec % 3600 / 60).cast("int"), (sec % 60).cast("int"))
    section = F.concat(F.lit("## ["), stamp, F.lit("] "), F.col("role"), F.lit("\n\n"), F.regexp_replace(F.coalesce("text", F.lit("")), "#", ""))
    body = turns.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", section.alias("s")))), lambda x: x["s"]), "\n\n").alias("body"))
    head = F.format_string('---\nepisode_number: %d\nepisode_date: 2024-01-01\ntitle: "Talk %d"\nyoutube_id: "vid%08d"\n---\n', "conv_id", "conv_id", "conv_id")
    return body.select(F.format_string("EP-%d", "conv_id").alias("episode_id"), F.concat(head, "body").alias("text"))


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as markdown summaries with takeaways, protocols, overview and resources."""
    clean = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), r"[*#\[\]|`-]", ""), r"\s+", " "))
    word = lambda i: F.coalesce(F.try_element_at(F.split("t", " "), F.lit(i)), F.lit("x"))
    docs = spread(table(spark, sf_dir, "documents")).withColumn("t", clean)
    text = F.concat(
        F.lit("---\nnúmero_episodio: "), F.col("doc_id").cast("string"), F.lit("\ninvitado: '"), F.regexp_replace(word(1), "['\"]", ""), F.lit("'\ntemas:\n- "), F.col("source"), F.lit(" tema\n- otro\n---\n# Episodio "),
        F.col("doc_id").cast("string"), F.lit(": Parte "), F.col("lang"), F.when(F.col("doc_id") % 2 == 0, F.lit("\n\n## Resumen del Episodio\n")).otherwise(F.lit("\n\n## DESCRIPCIÓN GENERAL DEL EPISODIO\n")), F.col("t"),
        F.lit("\n\n## Puntos Clave\n- **Uno** "), F.col("t"), F.lit("\n1. **Dos** "), word(2), F.lit("\n\n## Herramientas y Protocolos\n### Metodo\n**Qué:** "), word(2),
        F.when(F.col("doc_id") % 2 == 0, F.lit("\n**Cómo:** ")).otherwise(F.lit("\n**CÓMO:** ")), word(3), F.lit("\n**Cuándo:** "), word(4), F.lit("\n\n## Recursos Mencionados\n"), F.col("t"), F.lit("\n"),
    )
    return docs.select(F.format_string("EP-%d", "doc_id").alias("episode_id"), text.alias("text"))


def translations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sources with headers, and translations in five states by ``doc_id % 5``: same, cut, doubled, a header mark lost, a ghost title."""
    docs = spread(table(spark, sf_dir, "documents").filter("text is not null"))
    half = (F.length("text") / 2).cast("int")
    flat = F.regexp_replace("text", r"[#\[\]]|---|title:", "")
    head = F.lit("---\ntitle: one\n---\n")
    a, b = F.substring(flat, F.lit(1), half), F.substring(flat, half + 1, F.length("text"))
    source = F.concat(head, F.lit("## [00:00:10] First\n"), a, F.lit("\n## [00:10:00] Second\n"), b, F.lit("\n"))
    kind = F.col("doc_id") % 5
    lost = F.concat(head, F.lit("## [00:00:10] First\n"), a, F.lit("\n[00:10:00] Second\n"), b, F.lit("\n"))
    ghost = F.concat(head, F.lit("---\ntitle: again\n---\n## [00:00:10] First\n"), a, F.lit("\n## [00:10:00] Second\n"), b, F.lit("\n"))
    text = F.when(kind == 0, source).when(kind == 1, F.substring(source, F.lit(1), half)).when(kind == 2, F.concat(source, source)).when(kind == 3, lost).otherwise(ghost)
    return docs.select(F.col("doc_id").alias("episode_id"), source.alias("text")), docs.select(F.col("doc_id").alias("episode_id"), text.alias("text"))
