"""A stored inverted index: built once, added to and removed from in segments, searched without reading documents.

``postings``: a row a block of about BLOCK documents of one term (and scope), with their positions, written by
``bucket`` (a hash of the term) and sorted by term. Documents of a block have about the same number of
occurrences (its ``level``), and a block is chosen by the document's hash, so a term of any frequency is spread
over blocks of bounded size. ``terms``: documents of each term and level, one small row each.

A search reads the rows of its terms only. A query of one word takes the highest levels that hold enough
documents; lower ones cannot rank among the best and are skipped. A query of several words reads its rarest term
first; of the others it reads the blocks that may hold a document found there. Ranks are those of ``lexical``.

A segment holds documents added together. Removed (or added again) ids are listed with the segment from which on
they are gone; ``merge_segments`` writes one segment without them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lorebank.operators.kb import maybe_broadcast
from lorebank.operators.lexical import WEIGHT, parse_query, text_rank, tokenize
from lorebank.sources import manifest

#: Documents of a block, on average at most.
BLOCK = 128
#: Folders by term (stored with an index), and files of a folder over which a frequent term is spread.
BUCKETS, SLICES = 32, 8
#: Levels up to here are exact numbers of occurrences.
EXACT_LEVELS = 16
#: Terms that are pushed down to the files' statistics; rows of a search's own tables up to which they are settled (and blocks are chosen).
PUSHED_TERMS, SETTLED_ROWS = 500, 50_000


@dataclass(frozen=True)
class TextIndex:
    root: str
    config: str = "plain"
    scoped: bool = False

    def state(self, spark: SparkSession) -> dict:
        found = manifest.latest(spark, self.root)
        if found is None:
            raise ValueError(f"no index in {self.root}")
        return found

    def read(self, spark: SparkSession, name: str, state: dict) -> DataFrame:
        """Rows of the committed segments of ``postings`` or ``terms``."""
        kind = state["id"]
        own = f"docs array<struct<id: {kind}, positions: array<int>>>, n int" if name == "postings" else "spread int, n bigint"
        extra = ", block int" if name == "postings" else ""
        schema = f"term string, scope string, level int{extra}, {own}, segment int, bucket int"
        paths = [f"{self.root}/{name}/segment={s}" for s in state["segments"]]
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*paths)

    def removed(self, spark: SparkSession, state: dict) -> DataFrame | None:
        """id, gone: the segment from which on a removed id may live again."""
        if not state["removed"]:
            return None
        paths = [f"{self.root}/removed/segment={s}" for s in state["removed"]]
        rows = spark.read.schema(f"id {state['id']}, segment int").option("basePath", f"{self.root}/removed").parquet(*paths)
        return rows.groupBy("id").agg(F.max("segment").alias("gone"))


def bucket_of(term: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def settled(df: DataFrame, limit: int = SETTLED_ROWS) -> tuple[DataFrame, bool]:
    """A table of at most ``limit`` rows, computed once and broadcast by each join; a larger one as it is. And which it was."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return df, False
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)), True


def level_of(n: Column) -> Column:
    """A number of occurrences as its level: itself, then one a power of two."""
    return F.when(n < EXACT_LEVELS, n).otherwise(F.lit(EXACT_LEVELS - 4) + F.floor(F.log2(n))).cast("int")


def document_terms(docs: DataFrame, config: str, id_col: str, text_col: str, scope: str | None) -> DataFrame:
    """id, scope, term, positions: a row for each term of a document, grouped within the document's own task."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), (F.col(scope).cast("string") if scope else F.lit(None).cast("string")).alias("scope"), tokenize(F.col(text_col), config).alias("t"))

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 500):
                batch = whole.slice(first, 500)
                lists = batch.column(2)
                flat = lists.flatten()
                if not len(flat):
                    continue
                codes = flat.field("term").dictionary_encode()
                owner = lists.value_parent_indices().to_numpy()
                code, pos = codes.indices.to_numpy(), flat.field("pos").to_numpy()
                order = np.lexsort((pos, code, owner))
                owner, code, pos = owner[order], code[order], pos[order]
                new = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (code[1:] != code[:-1])))
                at = pa.array(owner[new])
                yield pa.record_batch(
                    [batch.column(0).take(at), batch.column(1).take(at), codes.dictionary.take(pa.array(code[new])), pa.ListArray.from_arrays(pa.array(np.append(new, len(pos)), pa.int32()), pa.array(pos, pa.int32()))],
                    names=["id", "scope", "term", "positions"],
                )

    return rows.mapInArrow(grouped, f"id {kind}, scope string, term string, positions array<int>")


def _write_segment(rows: DataFrame, root: str, segment: int, buckets: int) -> None:
    """rows: id, scope, term, positions. They are written once before they are counted and dealt into blocks."""
    spark, work = rows.sparkSession, f"{root}/work/segment={segment}"
    rows = rows.withColumn("level", level_of(F.size("positions")))
    rows.write.mode("overwrite").parquet(work)
    placed = spark.read.schema(rows.schema).parquet(work)
    counts = placed.groupBy("term", "scope", "level").agg(F.count(F.lit(1)).alias("n"))
    # A power of two, so that a block holds a range of the hash whatever the level.
    spread = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("n") / F.lit(float(BLOCK)))))).cast("int")
    stats = counts.withColumn("spread", spread).withColumn("bucket", bucket_of("term", buckets))
    stats.repartition("bucket").sortWithinPartitions("bucket", "term").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/terms/segment={segment}")
    wide = spark.read.schema(stats.schema).parquet(f"{root}/terms/segment={segment}").filter("spread > 1").select(F.col("term").alias("_t"), F.col("scope").alias("_s"), F.col("level").alias("_l"), F.col("spread"))
    met = placed.join(maybe_broadcast(wide), (F.col("term") == F.col("_t")) & F.col("scope").eqNullSafe(F.col("_s")) & (F.col("level") == F.col("_l")), "left")
    block = F.pmod(F.xxhash64("id"), F.coalesce("spread", F.lit(1))).cast("int")
    dealt = met.select(bucket_of("term", buckets).alias("bucket"), block.alias("block"), "term", "scope", "level", F.struct("id", "positions").alias("doc"))
    dealt = dealt.withColumn("slice", F.pmod("block", F.lit(SLICES))).repartition("bucket", "slice")
    blocks = dealt.groupBy("bucket", "slice", "term", "scope", "level", "block").agg(F.collect_list("doc").alias("docs")).withColumn("n", F.size("docs")).drop("slice")
    blocks.sortWithinPartitions("bucket", "term", "level").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/postings/segment={segment}")


def build_text_index(docs: DataFrame, root: str, config: str = "plain", id_col: str = "id", text_col: str = "content", scope: str | None = None, buckets: int = BUCKETS) -> TextIndex:
    """Writes an index of documents with distinct ids. ``scope``: a column; searches within a scope read its postings only.

    ``buckets``: folders by term; one for each few GB of postings."""
    spark = docs.sparkSession
    state = manifest.latest(spark, root) or {}
    segment = state.get("last", 0) + 1
    _write_segment(document_terms(docs, config, id_col, text_col, scope), root, segment, buckets)
    kind = docs.schema[id_col].dataType.simpleString()
    manifest.commit(spark, root, state | {"segments": [segment], "removed": [], "last": segment, "id": kind, "config": config, "scoped": scope is not None, "buckets": buckets})
    return TextIndex(root, config, scope is not None)


def add_documents(index: TextIndex, docs: DataFrame, id_col: str = "id", text_col: str = "content", scope: str | None = None) -> None:
    """Adds documents, or puts them in the place of those of the same id. What is stored already is not read."""
    spark = docs.sparkSession
    state = index.state(spark)
    segment = state["last"] + 1
    _write_segment(document_terms(docs, index.config, id_col, text_col, scope), index.root, segment, state["buckets"])
    docs.select(F.col(id_col).cast(state["id"]).alias("id")).distinct().write.mode("overwrite").parquet(f"{index.root}/removed/segment={segment}")
    manifest.commit(spark, index.root, state | {"segments": [*state["segments"], segment], "removed": [*state["removed"], segment], "last": segment})


def remove_documents(index: TextIndex, ids: DataFrame) -> None:
    """ids: id. They are not found any more; their postings go with the next merge."""
    spark = ids.sparkSession
    state = index.state(spark)
    segment = state["last"] + 1
    ids.select(F.col("id").cast(state["id"]).alias("id")).distinct().write.mode("overwrite").parquet(f"{index.root}/removed/segment={segment}")
    manifest.commit(spark, index.root, state | {"removed": [*state["removed"], segment], "last": segment})


def merge_segments(spark: SparkSession, index: TextIndex) -> None:
    """One segment in place of all, without removed documents."""
    state = index.state(spark)
    segment = state["last"] + 1
    rows = _living(index, spark, state, index.read(spark, "postings", state).select("term", "scope", "segment", F.explode("docs").alias("d")))
    _write_segment(rows.select("d.id", "scope", "term", "d.positions"), index.root, segment, state["buckets"])
    manifest.commit(spark, index.root, state | {"segments": [segment], "removed": [], "last": segment})


def _living(index: TextIndex, spark: SparkSession, state: dict, rows: DataFrame) -> DataFrame:
    """rows with segment and d (id, positions), without those whose id was removed later."""
    gone = index.removed(spark, state)
    if gone is None:
        return rows
    met = rows.join(maybe_broadcast(gone.withColumnRenamed("id", "_gone")), F.col("d.id") == F.col("_gone"), "left")
    return met.filter(F.col("gone").isNull() | (F.col("segment") >= F.col("gone"))).drop("_gone", "gone")


def index_stats(spark: SparkSession, index: TextIndex) -> DataFrame:
    """terms, postings (pairs of document and term) and the blocks' largest number of documents, of all committed segments."""
    state = index.state(spark)
    pairs = index.read(spark, "terms", state).agg(F.count_distinct("term").alias("terms"), F.coalesce(F.sum("n"), F.lit(0)).alias("postings"))
    held = index.read(spark, "postings", state).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("held"))
    return pairs.crossJoin(held)  # two single rows


def _of_terms(rows: DataFrame, wanted: DataFrame, buckets: int) -> DataFrame:
    """Rows of the wanted terms' buckets, and of the terms themselves by the files' statistics where these are few."""
    found = wanted.groupBy(bucket_of("term", buckets).alias("b")).agg(F.slice(F.collect_set("term"), 1, PUSHED_TERMS + 1).alias("terms"))
    own = found.collect()  # a row for each bucket at most
    out, terms = rows.filter(F.col("bucket").isin([r.b for r in own])), [t for r in own for t in r.terms]
    return out.filter(F.col("term").isin(terms)) if len(terms) <= PUSHED_TERMS else out


def index_candidates(queries: DataFrame, index: TextIndex, k: int | None = None) -> DataFrame:
    """Documents that match: query_text, scope (of a scoped index), id, text_rank. queries: query_text (and scope).

    With ``k``, one-word queries may leave out documents that cannot be among their k best. Tables of the queries
    themselves are computed once and broadcast while they are small (``settled``); else the joins shuffle."""
    spark = queries.sparkSession
    state = index.state(spark)
    by = ["query_text", "scope"] if index.scoped else ["query_text"]
    on = ["term", "scope"] if index.scoped else ["term"]
    parsed = queries.select(*by).distinct().withColumn("q", parse_query(F.col("query_text"), index.config)).filter(F.size("q.groups") > 0)
    terms = F.array_distinct(F.concat(F.flatten(F.flatten("q.groups")), F.flatten("q.excluded")))
    single = (F.size("terms") == 1) & (F.size("excluded") == 0) & F.forall(F.flatten("groups"), lambda phrase: F.size(phrase) == 1)
    parsed, _ = settled(parsed.select(*by, F.col("q.groups").alias("groups"), F.col("q.excluded").alias("excluded"), terms.alias("terms")).withColumn("single", single))
    asked = parsed.select(*by, "single", F.explode("terms").alias("term"))
    stats = _of_terms(index.read(spark, "terms", state), asked, state["buckets"])
    postings = _of_terms(index.read(spark, "postings", state), asked, state["buckets"])
    stats, postings = (stats, postings) if index.scoped else (stats.drop("scope"), postings.drop("scope"))
    levels, _ = settled(stats.join(asked, on).groupBy(*by, "single", "term", "level").agg(F.sum("n").alias("n")))

    # One word: the levels that hold the k best, counted without what may have been removed.
    one = levels.filter("single")
    if k is not None:
        gone = index.removed(spark, state)
        spare = gone.count() if gone is not None else 0
        above = F.sum("n").over(Window.partitionBy(*by).orderBy(F.desc("level"))) - F.col("n")
        one = one.withColumn("_above", above).filter(F.col("_above") < k + spare)
    read = postings.join(settled(one.select(*by, "term", "level"))[0], [*on, "level"])
    found = _living(index, spark, state, read.select(*by, "segment", F.explode("docs").alias("d")))
    ranked = found.select(*by, F.col("d.id").alias("id"), (F.size("d.positions") * F.lit(WEIGHT)).alias("text_rank"))

    # Several words: each group by its rarest term; groups with a term that no document has match nothing.
    more = parsed.filter("not single")
    if more.isEmpty():
        return ranked
    frequency = levels.filter("not single").groupBy(*by, "term").agg(F.sum("n").alias("df"))
    parts = more.select(*by, F.posexplode("groups").alias("g", "group")).select(*by, "g", F.explode(F.array_distinct(F.flatten("group"))).alias("term"))
    rarest = parts.join(frequency, [*by, "term"], "left").groupBy(*by, "g").agg(F.min_by("term", F.struct("df", "term")).alias("lead"), F.count_if(F.col("df").isNull()).alias("missing")).filter("missing = 0")
    lead, _ = settled(rarest.select(*by, F.col("lead").alias("term")).distinct())
    first = _living(index, spark, state, postings.join(lead, on).select(*by, "segment", F.explode("docs").alias("d")))
    candidates, few = settled(first.select(*by, F.col("d.id").alias("id")).distinct())
    others = asked.filter("not single").drop("single")
    if few:
        spreads = stats.join(others.select(*on).distinct(), on, "left_semi").select(*on, "level", "segment", "spread")
        blocks = candidates.join(others, by).join(spreads, on).select(*on, "level", "segment", F.pmod(F.xxhash64("id"), "spread").cast("int").alias("block")).distinct()
        postings = postings.join(settled(blocks)[0], [*on, "level", "segment", "block"], "left_semi")
    met = postings.join(others, on).select(*by, "term", "segment", F.explode("docs").alias("d"))
    held = _living(index, spark, state, met).select(*by, "term", F.col("d.id").alias("id"), "d.positions").join(candidates, [*by, "id"], "left_semi")
    hits = held.groupBy(*by, "id").agg(F.collect_list("term").alias("terms"), F.collect_list("positions").alias("positions"))
    whole = hits.join(more.select(*by, "groups", "excluded"), by)
    several = whole.select(*by, "id", text_rank("groups", "excluded", "terms", "positions").alias("text_rank")).filter("text_rank is not null")
    return ranked.unionByName(several)


def indexed_topk(queries: DataFrame, index: TextIndex, k: int = 50, rows: DataFrame | None = None) -> DataFrame:
    """query_id, id, text_rank, rank: the k best of each query, ties by id; as ``lexical.text_topk``, from the stored index.

    queries: query_id, query_text, and scope where the index has one. ``rows``: ids that may be found (with a column
    ``scope`` those of the query's scope only); the index must hold them all, and then no level is skipped."""
    found = index_candidates(queries, index, k if rows is None else None)
    by = ["query_text", "scope"] if index.scoped else ["query_text"]
    if rows is not None:
        keep = ["id", "scope"] if index.scoped and "scope" in rows.columns else ["id"]
        found = found.join(rows, keep)
        by += ["scope"] if "scope" in rows.columns and not index.scoped else []
    best = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("text_rank"), "id"))).filter(F.col("rank") <= k)
    return queries.select("query_id", *by).join(best, by).select("query_id", "id", "text_rank", "rank")
