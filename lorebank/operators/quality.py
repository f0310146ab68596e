"""Audits: translations against their sources, repeated text, advertising rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorebank.functions.packing import strip_ghost_blocks
from lorebank.functions.text import HEADING_MARK, lost_headings, md_counts, normalize_newlines, normalized, restore_headings

# Shares of the source's length, and headers that may be missing.
TRUNCATED, INFLATED, MISSING_HEADERS = 0.85, 1.40, -2


def pair_docs(progress: DataFrame, raw: DataFrame, translated: DataFrame, key: str = "episode_id") -> tuple[DataFrame, DataFrame]:
    """Pairs (key, source, translation) of what is marked done, and keys marked done of which a file is missing."""
    done = progress.filter("transcript").select(key)
    met = done.join(raw.select(key, F.col("text").alias("source")), key, "left").join(translated.select(key, F.col("text").alias("translation")), key, "left")
    whole = F.col("source").isNotNull() & F.col("translation").isNotNull()
    return met.filter(whole), met.filter(~whole).select(key, F.col("source").isNull().alias("no_source"), F.col("translation").isNull().alias("no_translation"))


def _verdict(ratio: Column, titles: Column, diff: Column, heads: Column) -> Column:
    return (
        F.when(ratio < TRUNCATED, "truncated").when(ratio > INFLATED, "inflated").when(titles > 1, "ghost title").when(heads & (diff <= MISSING_HEADERS), "missing headers")
    )


def _source_measures(text: Column) -> Column:
    source = normalize_newlines(text)
    return F.struct(md_counts(source).getField("headers").alias("headers"), F.length(source).alias("chars"))


def _repaired(df: DataFrame, text: str) -> DataFrame:
    """Replaces a text by what the audit asks of it: _text without repeated front matter, and its measures.

    Lost header marks are counted only: each one that is put back adds a header and three characters."""
    lines = df.withColumn("_n", normalize_newlines(F.col(text))).drop(text)
    seen = lines.withColumn("_g", strip_ghost_blocks(F.col("_n"))).drop("_n")
    seen = seen.withColumns({"_text": F.col("_g.text"), "_removed": F.col("_g.removed")}).drop("_g")
    return seen.withColumns({"_counts": md_counts(F.col("_text")), "_chars": F.length("_text"), "_lost": lost_headings(F.col("_text"))})


def _judged(pairs: DataFrame, key: str) -> DataFrame:
    """pairs: _source (measures) and the columns of ``_repaired``."""
    heads = F.col("_source.headers") > 0
    fixed = F.when(heads, F.col("_lost")).otherwise(0)
    ratio = F.try_divide(F.col("_chars") + F.length(F.lit(HEADING_MARK)) * fixed, F.col("_source.chars"))
    titles, diff = F.col("_counts.titles"), F.col("_counts.headers") + fixed - F.col("_source.headers")
    reason = _verdict(ratio, titles, diff, heads)
    return pairs.select(
        key, ratio.alias("ratio"), titles.alias("title_count"), diff.alias("header_diff"), F.col("_removed").alias("removed_blocks"), fixed.alias("headings_fixed"),
        F.when(reason.isNotNull(), "discarded").when((F.col("_removed") > 0) | (fixed > 0), "patched").otherwise("ok").alias("status"), reason.alias("reason"),
        F.when(heads, restore_headings(F.col("_text")).getField("text")).otherwise(F.col("_text")).alias("text"),
    )


def audit_translation(pairs: DataFrame, key: str = "episode_id") -> DataFrame:
    """Repairs each translation and judges what comes out: status ok, patched or discarded, and the first reason."""
    return _judged(_repaired(pairs.withColumn("_source", _source_measures(F.col("source"))).drop("source"), "translation"), key)


def audit_done(progress: DataFrame, raw: DataFrame, translated: DataFrame, key: str = "episode_id") -> DataFrame:
    """The audit of all that is marked done and whole. Measures are joined: no source is shuffled, and repaired
    translations only where ``text`` is asked for."""
    source = raw.select(key, _source_measures(F.col("text")).alias("_source")).filter("_source.chars is not null")
    there = _repaired(translated.select(key, "text").filter("text is not null"), "text")
    return _judged(progress.filter("transcript").select(key).join(source, key).join(there, key), key)


def progress_after(progress: DataFrame, audit: DataFrame, key: str = "episode_id") -> DataFrame:
    """The done flags after an audit: a discarded text is not done any more, so the work list has it again."""
    off = audit.filter("status = 'discarded'").select(key).distinct().withColumn("_off", F.lit(True))
    return progress.join(off, key, "left").withColumn("transcript", F.col("transcript") & F.col("_off").isNull()).drop("_off")


def audit_summary(audit: DataFrame) -> DataFrame:
    return audit.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def verify_structure(raw: DataFrame, translated: DataFrame, key: str = "episode_id") -> DataFrame:
    """Header and fence counts of a translation against its source. Counts are joined, texts are not."""
    own = lambda df, name: df.select(key, md_counts(F.col("text")).alias(name))
    met = own(raw, "s").join(own(translated, "t"), key)
    diff = F.col("t.headers") - F.col("s.headers")
    return met.select(
        key, F.col("s.headers").alias("source_headers"), F.col("t.headers").alias("headers"),
        F.when(diff > 0, "hallucinated").when(diff < 0, "omitted").otherwise("ok").alias("header_status"), (F.col("t.fences") != F.col("s.fences")).alias("stray_fence"),
    )


def repeated_text(df: DataFrame, text: str, source: str, min_sources: int) -> DataFrame:
    """Hashes of normalised texts that occur in so many sources. Only hash and source are shuffled, each pair once a task."""
    rows = df.filter(F.coalesce(normalized(F.col(text)), F.lit("")) != "").select(F.sha2(normalized(F.col(text)), 256).alias("text_sha"), F.col(source).alias("source"))
    pairs = rows.groupBy("text_sha", "source").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("text_sha").agg(F.count("source").alias("sources"), F.sum("n").alias("rows")).filter(F.col("sources") >= min_sources)


def flag_ads(df: DataFrame, keywords: list[str], min_sources: int, max_chars: int = 2000, exempt_topics: tuple[str, ...] = (), text: str = "content", source: str = "episode_number", segment_topic: str = "transcript_segment") -> DataFrame:
    """Adds ``is_ad``: a sponsor keyword or repetition across sources, in a segment short enough; exempt topics never."""
    again = repeated_text(df, text, source, min_sources).select(F.col("text_sha").alias("_sha"))
    own = df.withColumn("_t", F.sha2(normalized(F.col(text)), 256)).join(again, F.col("_t") == F.col("_sha"), "left")
    word = F.lower(F.col(text)).rlike("|".join(keywords)) if keywords else F.lit(False)
    short = (F.col("topic") != segment_topic) | (F.length(text) < max_chars)
    flag = (word | F.col("_sha").isNotNull()) & short & ~F.col("topic").isin(*exempt_topics) if exempt_topics else (word | F.col("_sha").isNotNull()) & short
    return own.withColumn("is_ad", F.coalesce(flag, F.lit(False))).drop("_t", "_sha")


def rule_report(flags: DataFrame, truth: DataFrame, by: str) -> DataFrame:
    """Caught, missed and wrongly hit rows by content type and in all (``all``). flags: id, is_ad, by. truth: id, bad."""
    met = flags.join(truth.select("id", "bad"), "id")
    bad = F.col("bad")
    return met.rollup(by).agg(
        F.count_if(bad & F.col("is_ad")).alias("caught"), F.count_if(bad & ~F.col("is_ad")).alias("missed"), F.count_if(~bad & F.col("is_ad")).alias("wrong")
    ).withColumn(by, F.coalesce(by, F.lit("all")))
