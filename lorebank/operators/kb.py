"""Rows of the knowledge base: shaping, layers, visibility, dates and upserts.

Columns of the table: id, tenant_id, brand_id, topic, content, embedding, episode_number, episode_date,
timestamp_start, timestamp_end, active.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lorebank.functions.text import (
    OVERVIEW_HEADER, PROTOCOLS_HEADER, RESOURCES_HEADER, TAKEAWAYS_HEADER, default_topic, episode_key, episode_of, extract_section,
    overview_row, parse_frontmatter, parse_protocols, parse_takeaways, resources_row, row_id, slugify,
)

#: Rows and bytes of a lookup table up to which it may be broadcast; above, the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 2_000_000, 64 << 20


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a table is within both bounds. One job; only widths are gathered, and no more of them than the bound."""
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.NullType)
    wide = [f"`{f.name}`" for f in df.schema.fields if not isinstance(f.dataType, fixed)]
    width = reduce(lambda x, y: x + y, [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)).cast("bigint") for c in wide], F.lit(16 * len(df.columns)).cast("bigint"))
    seen = df.select(width.alias("width")).limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("width"), F.lit(0)).alias("bytes")).first()
    return seen["n"] <= rows and seen["bytes"] <= size


def maybe_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """A broadcast hint for a table that was measured and is small; no hint for any other."""
    return F.broadcast(df) if is_small(df, limit, size) else df


def summary_rows(files: DataFrame) -> DataFrame:
    """files: episode_id, text (markdown summaries). KB rows id, topic, text, active: takeaways, protocols, overview, resources.

    Items are numbered after short ones are dropped."""
    read = files.withColumn("fm", parse_frontmatter("text"))
    key = episode_key(F.col("fm.meta")["número_episodio"], F.col("episode_id"))
    read = read.select(
        "text", key.alias("key"), slugify(F.coalesce(F.nullif(F.try_element_at("fm.temas", F.lit(1)), F.lit("")), F.lit("neurociencia"))).alias("topic"),
        F.coalesce(F.col("fm.meta")["invitado"], F.lit("")).alias("guest"), F.regexp_extract("text", r"(?m)^#\s*Episodio\s*\d+:\s*(.+)$", 1).alias("title"),
    )
    col = F.col("text")
    lists = F.concat(
        F.transform(parse_takeaways(extract_section(col, TAKEAWAYS_HEADER)), lambda t, i: F.struct(F.concat(F.lit("tk"), (i + 1).cast("string")).alias("s"), t.alias("t"))),
        F.transform(parse_protocols(extract_section(col, PROTOCOLS_HEADER)), lambda t, i: F.struct(F.concat(F.lit("proto"), (i + 1).cast("string")).alias("s"), t.alias("t"))),
        F.array(
            F.struct(F.lit("overview").alias("s"), overview_row(F.col("key"), F.col("title"), F.col("guest"), extract_section(col, OVERVIEW_HEADER)).alias("t")),
            F.struct(F.lit("recursos").alias("s"), resources_row(F.col("key"), F.col("title"), extract_section(col, RESOURCES_HEADER)).alias("t")),
        ),
    )
    rows = read.select("key", "topic", F.explode(F.filter(lists, lambda x: x["t"].isNotNull())).alias("x"))
    return rows.select(row_id(F.col("key"), F.col("x.s")).alias("id"), "topic", F.col("x.t").alias("text"), F.lit("true").alias("active"))


def active_rows(df: DataFrame) -> DataFrame:
    return df.filter((F.coalesce(F.col("id"), F.lit("")) != "") & (F.col("active") == "true"))


def visible(df: DataFrame, tenant: str | None = None, brand: str | None = None, need_vector: bool = False) -> DataFrame:
    """Active rows of a tenant, and where asked of a brand and with a vector."""
    out = df.filter("active")
    if tenant is not None:
        out = out.filter(F.col("tenant_id") == tenant)
    if brand is not None:
        out = out.filter(F.col("brand_id") == brand)
    return out.filter(F.col("embedding").isNotNull()) if need_vector else out


def resolve_brand(requests: DataFrame, brands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """requests: query_id, tenant_id, brand_id or null. Requests with an active brand of their tenant, and the rejected."""
    live = brands.filter("active").select("tenant_id", F.col("id").alias("found"), "is_default")
    asked = requests.join(live.filter("is_default").groupBy("tenant_id").agg(F.min("found").alias("own")), "tenant_id", "left")
    asked = asked.withColumn("wanted", F.coalesce("brand_id", "own"))
    known = live.select("tenant_id", F.col("found").alias("wanted"), "found").distinct()
    met = asked.join(known, ["tenant_id", "wanted"], "left")
    keep = [c for c in requests.columns if c != "brand_id"]
    good = met.filter(F.col("found").isNotNull()).select(*keep, F.col("found").alias("brand_id"))
    return good, met.filter(F.col("found").isNull()).select(*keep, "brand_id")


def to_kb_rows(rows: DataFrame, dates: DataFrame, tenant: str) -> DataFrame:
    """rows: id, topic, text, active. dates: key (three digits or more), date."""
    shaped = active_rows(rows).select(
        "id", F.lit(tenant).alias("tenant_id"), default_topic(F.col("topic")).alias("topic"), F.col("text").alias("content"), episode_of(F.col("id")).alias("episode_number"), F.lit(True).alias("active")
    )
    return with_episode_date(shaped, dates)


def chunks_to_kb_rows(chunks: DataFrame, tenant: str) -> DataFrame:
    """Transcript chunks as KB rows; ``embed_input`` (title and content) is for the embedder and not stored."""
    return chunks.select(
        "id", F.lit(tenant).alias("tenant_id"), F.lit("transcript_segment").alias("topic"), "content", "episode_number", F.to_date("episode_date").alias("episode_date"),
        "timestamp_start", "timestamp_end", F.lit(True).alias("active"), F.concat(F.col("section_title"), F.lit(". "), F.col("content")).alias("embed_input"),
    )


def with_episode_date(df: DataFrame, dates: DataFrame) -> DataFrame:
    """Adds ``episode_date`` by the number in ``dates.key``; missing or null gives null."""
    known = dates.select(F.col("key").try_cast("int").alias("episode_number"), F.to_date("date").alias("episode_date")).dropna(subset=["episode_number"]).dropDuplicates(["episode_number"])
    return df.join(maybe_broadcast(known), "episode_number", "left")


def with_video_id(df: DataFrame, videos: DataFrame) -> DataFrame:
    """Adds ``video_id`` by episode number."""
    return df.join(maybe_broadcast(videos.select("episode_number", "video_id")), "episode_number", "left")


def remove_lot(df: DataFrame, topic: str) -> DataFrame:
    """Takes one load lot back, by its topic."""
    return df.filter(F.coalesce(F.col("topic") != topic, F.lit(True)))


def deactivate(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Sets ``active`` to false for the ids; nothing is deleted."""
    off = maybe_broadcast(ids.select(F.col("id").alias("_off")).distinct())
    return df.join(off, F.col("id") == F.col("_off"), "left").withColumn("active", F.col("active") & F.col("_off").isNull()).drop("_off")


def union_kb(*layers: DataFrame) -> DataFrame:
    """Layers with the same columns, in any order."""
    return reduce(lambda a, b: a.unionByName(b), layers)


def add_layer(kb: DataFrame, layer: DataFrame) -> DataFrame:
    """A layer with other columns: what one side lacks is null."""
    return kb.unionByName(layer, allowMissingColumns=True)


def latest_by_key(df: DataFrame, key: str, order: Column | str) -> DataFrame:
    """The last row written for each key; rows of a hot key are combined before the shuffle."""
    whole = F.struct(*df.columns)
    return df.groupBy(key).agg(F.max_by(whole, order if isinstance(order, Column) else F.col(order)).alias("_row")).select("_row.*")


def append_lot(kb: DataFrame, lot: DataFrame, order: str) -> DataFrame:
    """A lot added, of equal ids the last; to add it twice changes nothing."""
    return latest_by_key(kb.unionByName(lot), "id", order)


def upsert(target: DataFrame, updates: DataFrame, key: str = "id", order: str | None = None) -> DataFrame:
    """Rows of ``updates`` win, column by column; columns that they lack are kept. Write the result to a new path.

    Updates are first reduced to one row a key (the last by ``order``): with the join that is one shuffle of
    each side on the key, none where both are bucketed by it. A null in an update overwrites.
    """
    one = latest_by_key(updates, key, order) if order else updates.dropDuplicates([key])
    own = [c for c in one.columns if c != key and c in target.columns]
    there = one.select(F.col(key), F.lit(True).alias("_new"), F.struct(*own).alias("_u"))
    joined = target.join(there, key, "full")
    return joined.select(*[F.when(F.col("_new"), F.col("_u")[c]).otherwise(F.col(c)).alias(c) if c in own else F.col(c) for c in target.columns])


def kb_stats(rows: DataFrame) -> DataFrame:
    """Sources with rows, rows by kind, and all."""
    kind = F.regexp_extract("id", r"-(tk|proto|overview|recursos|ts)", 1)
    return rows.agg(
        F.count_distinct(episode_of(F.col("id"))).alias("sources"), *[F.count_if(kind == k).alias(k) for k in ("tk", "proto", "overview", "recursos", "ts")], F.count(F.lit(1)).alias("total")
    )


def coverage(catalog: DataFrame, kb: DataFrame) -> DataFrame:
    """Catalogued sources that have rows, and that have none."""
    there = kb.select("episode_number").distinct().withColumn("_in", F.lit(True))
    return catalog.join(there, "episode_number", "left").agg(F.count_if(F.col("_in")).alias("indexed"), F.count_if(F.col("_in").isNull()).alias("not_indexed"))


def number_rows(df: DataFrame, by: list[str], order: list[str], name: str = "n") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
