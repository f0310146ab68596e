"""Transcripts into citable, time-stamped chunks with stable ids. Everything stays inside a document's row until the end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lorebank.functions.packing import split_long
from lorebank.functions.text import BLANK, NOT_LINE_END, chunk_id, filled, leading_int, padded, parse_transcript_meta, trimmed, ts_seconds

# Fixed value of the transcript format: a section header. A line begins and ends at any of four characters.
_HEADER = rf"(?:(?<=[\n\r\u2028\u2029])|^)##{BLANK}*\[?(\d{{1,2}}:\d{{2}}(?::\d{{2}})?)\]?{BLANK}+({NOT_LINE_END}*)(?=[\n\r\u2028\u2029]|\z)"

#: Stands for a header; the same character in a text is written with another one behind it.
_MARK, _CUT, _KEPT = "\u0001", "\u0001\u0003", "\u0001\u0002"


def split_sections(body: Column) -> Column:
    """Sections of ``## [hh:mm:ss] title`` lines: pos, ts, title, text, and the next section's ts as their end.

    Text before the first header is left out; blanks in a text become one space."""
    ts, title = F.regexp_extract_all(body, F.lit(_HEADER), F.lit(1)), F.regexp_extract_all(body, F.lit(_HEADER), F.lit(2))
    marked = F.regexp_replace(F.replace(body, F.lit(_MARK), F.lit(_KEPT)), _HEADER, _CUT)
    text = F.slice(F.split(marked, _CUT), 2, F.greatest(F.size(ts), F.lit(1)))
    own = lambda i: F.replace(F.coalesce(F.try_element_at(text, i + 1), F.lit("")), F.lit(_KEPT), F.lit(_MARK))
    return F.transform(
        ts,
        lambda t, i: F.struct(
            (i + 1).alias("pos"), t.alias("ts"), F.try_element_at(ts, i + 2).alias("ts_end"),
            trimmed(F.element_at(title, i + 1)).alias("title"),
            F.trim(F.regexp_replace(own(i), r"(?U)\s+", " ")).alias("text"),
        ),
    )


def dedupe_ids(df: DataFrame, doc: str, base: str, order: list[str]) -> DataFrame:
    """Adds ``id``: the base id, with ``-dup2``, ``-dup3``, … from its second occurrence in a document on."""
    n = F.row_number().over(Window.partitionBy(doc, base).orderBy(*order))
    return df.withColumn("_n", n).withColumn("id", F.when(F.col("_n") > 1, F.concat(F.col(base), F.lit("-dup"), F.col("_n").cast("string"))).otherwise(F.col(base))).drop("_n")


def chunk_transcripts(files: DataFrame, limit: int = 3000, least: int = 40, lossless: bool = False) -> DataFrame:
    """files: episode_id (EP-001), text. Rows of chunks; a section that is too short still ends the one before."""
    read = files.select("episode_id", parse_transcript_meta(F.col("text")).alias("m")).select(
        "episode_id", "m.body",
        F.coalesce(leading_int(F.col("m.meta")["episode_number"]), leading_int(F.regexp_replace("episode_id", "EP-", ""))).alias("episode_number"),
        filled(F.col("m.meta")["episode_date"]).alias("episode_date"),
        F.coalesce(F.col("m.meta")["title"], F.lit("")).alias("episode_title"),
    )
    sections = read.withColumn("s", F.explode(split_sections(F.col("body")))).drop("body").filter(F.length("s.text") >= least)
    parts = sections.withColumn("parts", split_long(F.col("s.text"), limit, lossless)).select("*", F.posexplode("parts").alias("part", "content"))
    base = chunk_id(padded(F.col("episode_number").cast("string")), F.col("s.ts"), F.col("part") + 1, F.size("parts"))
    return dedupe_ids(parts.withColumn("base_id", base), "episode_id", "base_id", ["s.pos", "part"]).select(
        "id", "episode_id", "episode_number", "episode_date", "episode_title", F.col("s.ts").alias("timestamp_start"), F.col("s.ts_end").alias("timestamp_end"),
        ts_seconds(F.col("s.ts")).alias("timestamp_start_seconds"), F.col("s.title").alias("section_title"), "content",
    )


def chunk_stats(sources: DataFrame, chunks: DataFrame) -> DataFrame:
    """sources: episode_id, has_file. Sources with chunks, those skipped by reason, chunks and their mean."""
    n = chunks.groupBy("episode_id").agg(F.count(F.lit(1)).alias("n"))
    each = sources.join(n, "episode_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return each.agg(
        F.count_if(F.col("n") > 0).alias("ok"), F.count_if(~F.col("has_file")).alias("no_file"), F.count_if(F.col("has_file") & (F.col("n") == 0)).alias("no_chunks"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("chunks"),
    ).withColumn("mean", F.round(F.col("chunks") / F.greatest(F.col("ok"), F.lit(1)), 3))
