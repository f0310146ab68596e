"""Citations with deep links, context of an answer, its confidence, and the video map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorebank.functions.text import leading_int, parse_transcript_meta, ts_seconds, video_id


def answer_confidence(cited: DataFrame) -> DataFrame:
    """The highest similarity of an answer's chunks, wherever it stands."""
    return cited.groupBy("query_id").agg(F.max("similarity").alias("confidence"))


def citation(df: DataFrame) -> DataFrame:
    """Adds ``citation`` and ``link``. df: episode_number, timestamp_start, video_id; a link needs a time and a video."""
    link = F.concat(F.lit("youtu.be/"), F.col("video_id"), F.lit("?t="), ts_seconds(F.col("timestamp_start")).cast("string"))
    n = F.col("episode_number").cast("string")
    with_time = F.concat(F.lit("[Episodio "), n, F.lit(" | "), F.col("timestamp_start"))
    said = (
        F.when(F.col("timestamp_start").isNull(), F.concat(F.lit("[Episodio "), n, F.lit("]")))
        .when(link.isNull(), F.concat(with_time, F.lit("]")))
        .otherwise(F.concat(with_time, F.lit(" → "), link, F.lit("]")))
    )
    return df.withColumn("citation", said).withColumn("link", F.when(F.col("timestamp_start").isNotNull(), link))


def build_context(retrieved: DataFrame, n: int) -> DataFrame:
    """One text a query: contents of its first n results in order."""
    rows = F.sort_array(F.collect_list(F.struct("pos", "content")))
    return retrieved.filter(F.col("pos") <= n).groupBy("query_id").agg(F.array_join(F.transform(rows, lambda r: r["content"]), "\n\n").alias("context"))


def video_rows(transcripts: DataFrame) -> DataFrame:
    """transcripts: episode_id, text. Episode number, valid video id or the reason there is none."""
    meta = parse_transcript_meta(F.col("text"))["meta"]
    number = F.coalesce(leading_int(meta["episode_number"]), leading_int(F.regexp_replace("episode_id", "EP-", "")))
    return transcripts.select("episode_id", number.alias("episode_number"), video_id(meta["youtube_id"]).alias("v")).select("episode_id", "episode_number", F.col("v.id").alias("video_id"), "v.reason")


def video_map(transcripts: DataFrame) -> DataFrame:
    """One video an episode, of several the last by source; in order of the number."""
    rows = video_rows(transcripts).filter("video_id is not null")
    return rows.groupBy("episode_number").agg(F.max_by("video_id", "episode_id").alias("video_id")).orderBy("episode_number")


def video_stats(transcripts: DataFrame) -> DataFrame:
    return video_rows(transcripts).groupBy(F.coalesce("reason", F.lit("ok")).alias("status")).count()
