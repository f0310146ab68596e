"""Exact dedup by content sort.

Spark samples splitters and deals rows by range of (first characters, hash of the text, doc_id), so that
equal texts are neighbours and a text with very many copies spreads over several ranges by doc_id. Each
range is sorted externally, then one pass compares each text in full with its neighbour. A run of equal
texts that touches an end of its range may go on in the next one: those runs, at most two a range, are
joined by comparing their whole texts.

Texts are equal when identical after lower-casing A-Z; null counts as empty. The row with the largest
doc_id stays. Rows that repeat both doc_id and text are copies too: exactly one of them stays. A null doc_id
is smaller than all others: such a row stays, as the only one, where no copy has an id, and keep_id is null.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorebank.llm.common import table, text_of
from lorebank.llm.scratch import checkpointed

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters of a text that a splitter holds.
SPLITTER_CHARS = 24
#: Stands for a null doc_id, beside a mask of nulls.
_LEAST = int(np.iinfo(np.int64).min)

_RUNS = pa.schema(
    [("doc_id", pa.int64()), ("text_sha256", pa.string()), ("run_max", pa.int64()), ("run_size", pa.int64()), ("again", pa.bool_()), ("edge_text", pa.string()), ("edge", pa.bool_())]
)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours. Of an open run only ids and hashes are held, and its text once."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]] = []  # of the open run: ids, null ids, repeats of the id before, hashes
    text, first, last_id, last_none = None, True, None, False

    def closed(edge: bool) -> pa.RecordBatch:
        ids, none = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        n = len(ids)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, mask=none), pa.concat_arrays([h[3] for h in held]), pa.array(np.full(n, ids.max()), mask=np.full(n, none.all())), pa.array(np.full(n, n)),
                pa.array(np.concatenate([h[2] for h in held])), pa.array([text if edge else None] + [None] * (n - 1), pa.string()), pa.array(np.full(n, edge)),
            ], schema=_RUNS)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        texts, sha = batch["text"], batch["sha"].cast(pa.string())
        none = batch["doc_id"].is_null().to_numpy(zero_copy_only=False)
        ids = batch["doc_id"].fill_null(_LEAST).to_numpy(zero_copy_only=False)
        new = np.ones(n, bool)
        if n > 1:
            new[1:] = pc.not_equal(texts[1:], texts[:-1]).to_numpy(zero_copy_only=False)
        new[0] = text is None or texts[0].as_py() != text
        again = np.zeros(n, bool)
        again[1:] = (ids[1:] == ids[:-1]) & (none[1:] == none[:-1]) & ~new[1:]
        again[0] = not new[0] and ids[0] == last_id and none[0] == last_none
        starts = np.flatnonzero(new)
        if held and len(starts):
            a = int(starts[0])
            if a:
                held.append((ids[:a], none[:a], again[:a], sha[:a]))
            yield closed(first)
            first, held = False, []
        if not len(starts):
            held.append((ids, none, again, sha))
            last_id, last_none = ids[-1], none[-1]
            continue
        a, b = int(starts[0]), int(starts[-1])
        if b > a and first:  # the first run of the range ends inside this batch
            c = int(starts[1])
            text = texts[a].as_py()
            held = [(ids[a:c], none[a:c], again[a:c], sha[a:c])]
            yield closed(True)
            first, a, starts = False, c, starts[1:]
        if b > a:  # whole runs inside the batch
            sizes = np.diff(starts)
            which = np.repeat(np.arange(len(sizes)), sizes)
            top = np.maximum.reduceat(ids[a:b], starts[:-1] - a)
            bare = np.logical_and.reduceat(none[a:b], starts[:-1] - a)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[a:b], mask=none[a:b]), sha[a:b], pa.array(top[which], mask=bare[which]), pa.array(sizes[which]), pa.array(again[a:b]), pa.nulls(b - a, pa.string()), pa.array(np.zeros(b - a, bool))],
                schema=_RUNS,
            )
        text, held, last_id, last_none = texts[b].as_py(), [(ids[b:], none[b:], again[b:], sha[b:])], ids[-1], none[-1]
    if held:
        yield closed(True)


def exact_groups(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.translate(text_of("text"), _UPPER, _LOWER).alias("text"))
    keys = [F.substring("text", 1, SPLITTER_CHARS).alias("head"), F.xxhash64("text").alias("h")]
    ranged = rows.select("doc_id", "text", *keys)
    ranged = ranged.repartitionByRange(partitions, "head", "h", "doc_id") if partitions else ranged.repartitionByRange("head", "h", "doc_id")
    ordered = ranged.sortWithinPartitions("head", "h", "text", "doc_id").select("doc_id", "text", F.sha2("text", 256).alias("sha"))
    runs = checkpointed(ordered.mapInArrow(_runs, "doc_id bigint, text_sha256 string, run_max bigint, run_size bigint, again boolean, edge_text string, edge boolean"))
    # At most two runs a range have an edge text, whatever the size of the data.
    edges = (
        runs.filter(F.col("edge_text").isNotNull())
        .groupBy("edge_text", "text_sha256")
        .agg(F.max("run_max").alias("all_max"), F.sum("run_size").alias("all_size"))
        .select(F.col("text_sha256").alias("edge_sha"), "all_max", "all_size")
    )
    joined = runs.join(F.broadcast(edges), F.col("edge") & (F.col("text_sha256") == F.col("edge_sha")), "left")
    keep = F.coalesce("all_max", "run_max")
    return joined.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("all_size", "run_size").alias("group_size"),
        (F.col("doc_id").eqNullSafe(keep) & ~F.col("again")).alias("kept"), "text_sha256",
    )


def exact_dedup(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """The documents that stay, with all their columns."""
    own_id, own = "_lorebank_doc_id", "_lorebank_text_sha256"  # no columns of the documents
    same_id = F.col("doc_id").eqNullSafe(F.col(own_id))
    groups = checkpointed(exact_groups(docs, partitions).select("doc_id", "kept", "keep_id", "group_size"))
    stay = groups.filter("kept").select(F.col("doc_id").alias(own_id))
    out = docs.join(stay.hint("merge"), same_id, "left_semi").select(*docs.columns)
    ids = groups.agg((F.count_distinct("doc_id") + F.count_if(F.col("doc_id").isNull()).cast("boolean").cast("int")).alias("n"), F.count(F.lit(1)).alias("rows")).first()
    if ids["n"] == ids["rows"]:
        return out
    # Some ids, or nulls, stand in several rows: of those with the same text, after folding, one stays.
    sha = F.sha2(F.translate(text_of("text"), _UPPER, _LOWER), 256)
    shas = exact_groups(docs, partitions).filter("kept").select(F.col("doc_id").alias(own_id), F.col("text_sha256").alias("_lorebank_kept_sha256"))
    again = docs.withColumn(own, sha).join(shas, same_id & (F.col(own) == F.col("_lorebank_kept_sha256")), "left_semi")
    return again.dropDuplicates(["doc_id", own]).select(*docs.columns)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


OP5_SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
