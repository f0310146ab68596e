"""The catalogue of sources, and documents compiled from their files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorebank.functions.text import filled, md_title


def episode_catalog(paths: DataFrame, root: str = "docs/Episodes/") -> DataFrame:
    """paths: path, n (order). One row an episode: id, title and folder (first seen), paths of its files (last seen).

    Under the root, not index.md, at least four parts, file summary.md or transcript.md. ``EP-1 - Title``
    splits at the first dash; without one id and title are the folder."""
    parts = F.split("path", "/")
    own = paths.filter(F.startswith("path", F.lit(root)) & ~F.endswith("path", F.lit("index.md")) & (F.size(parts) >= 4))
    file, folder = F.element_at(parts, -1), F.element_at(parts, -2)
    rows = own.select("path", "n", folder.alias("folder"), F.regexp_extract(file, r"^(summary|transcript)\.md$", 1).alias("kind")).filter("kind <> ''")
    at = F.locate(" - ", F.col("folder"))
    named = rows.withColumn("id", F.when(at > 0, F.trim(F.substring("folder", F.lit(1), at - 1))).otherwise(F.col("folder"))).withColumn(
        "title", F.when(at > 0, F.trim(F.substring("folder", at + 3, F.length("folder")))).otherwise(F.col("folder"))
    )
    last = lambda kind: F.max_by(F.when(F.col("kind") == kind, F.col("path")), F.when(F.col("kind") == kind, F.col("n")))
    return named.groupBy("id").agg(
        F.min_by("title", "n").alias("title"), F.min_by("folder", "n").alias("original_folder"), F.bool_or(F.col("kind") == "summary").alias("has_summary"),
        F.bool_or(F.col("kind") == "transcript").alias("has_transcript"), last("summary").alias("summary_path"), last("transcript").alias("transcript_path"),
    )


def compile_episodes(catalog: DataFrame, raw: DataFrame, translated: DataFrame) -> DataFrame:
    """catalog: id, title. raw, translated: id, kind (summary or transcript), text. One document an episode.

    Both trees meet the catalogue in one shuffle: their rows are united and pivoted by hand."""
    tree = lambda df, lang: df.select("id", F.concat_ws("_", "kind", F.lit(lang)).alias("what"), "text")
    rows = tree(raw, "en").unionByName(tree(translated, "es"))
    kinds = ["summary_en", "summary_es", "transcript_en", "transcript_es"]
    own = rows.groupBy("id").agg(*[F.max(F.when(F.col("what") == k, F.col("text"))).alias(k) for k in kinds])
    met = catalog.select("id", "title").join(own, "id", "left")
    title_en = md_title(F.coalesce("summary_en", F.lit("")), F.col("title"))
    return met.select(
        "id", title_en.alias("title_en"), md_title(F.coalesce("summary_es", F.lit("")), title_en).alias("title_es"), *[filled(F.col(k), "").alias(k) for k in kinds],
        F.col("summary_en").isNotNull().alias("has_summary"), F.col("summary_es").isNotNull().alias("has_summary_translated"),
        F.col("transcript_en").isNotNull().alias("has_transcript"), F.col("transcript_es").isNotNull().alias("has_transcript_translated"),
    )


def compact_index(docs: DataFrame, limit: int = 5000) -> DataFrame:
    """Titles and the first characters of summaries, and what is there."""
    return docs.select("id", "title_en", "title_es", F.substring("summary_en", 1, limit).alias("summary_en"), F.substring("summary_es", 1, limit).alias("summary_es"), "has_summary_translated", "has_transcript_translated")
