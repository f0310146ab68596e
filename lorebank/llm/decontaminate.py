"""Benchmark decontamination: a broadcast hash set of the windows of test items, checked against every text.

A word is a run of ASCII letters (lower-cased) and digits and of any character beyond ASCII. A window is
``window`` consecutive words of an item; an item of fewer words, but not none, is one window of all its
words. A document word inside any occurrence of a window is hit. Window hashes select candidates; each
candidate is then compared word by word, so a hash collision changes nothing.

The items are broadcast in blocks of at most ``max_block_bytes`` of text each (their size is summed first):
a benchmark of any size is handled, by one pass over the documents for each block. With several blocks the
documents are written once, each row with a key of its own, and the hits of each block are written before the
next block is built, so no task and no driver holds two indexes. Hits are united by row and position: the size
of a block changes no result. Texts are shuffled only to cut spans, or drop documents, of several blocks.

Null and empty texts have no words and no hits. An empty benchmark contaminates nothing. Repeated rows of
documents are scanned one by one; repeated items each count as an item by their id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lorebank.llm.common import Words, blocks, buffers, table, text_of
from lorebank.llm.scratch import checkpointed

WINDOW = 10
#: Bytes of item text broadcast at once.
MAX_BLOCK_BYTES = 16 << 20

#: Columns of our own: no columns of the documents.
ROW, SPOTS = "_lorebank_row", "_lorebank_spots"

HITS = "struct<n_words:bigint,n_hit:bigint,items:array<bigint>,hit_words:array<int>>"


class WindowIndex:
    """Windows by length: sorted hashes, and by hash the exact words with the items that hold them."""

    def __init__(self, items: list[tuple[int, str]], window: int):
        self.by_length: dict[int, tuple[np.ndarray, dict[int, dict[bytes, list[int]]]]] = {}
        texts = pa.array([t or "" for _, t in items], pa.large_string())
        words = Words(*buffers(texts))
        for n in sorted({min(window, k) for k in np.diff(words.first).tolist() if k}):
            hashes, found = words.window_hash(n), {}
            fits = words.whole(n)
            for i, (item, _) in enumerate(items):
                a, b = int(words.first[i]), int(words.first[i + 1])
                if min(window, b - a) != n:
                    continue
                for j in range(a, b - n + 1):
                    assert fits[j]
                    held = found.setdefault(int(hashes[j]), {}).setdefault(words.joined(j, n), [])
                    if item not in held:
                        held.append(item)
            self.by_length[n] = (np.array(sorted(found), np.uint64), found)

    def scan(self, texts: pa.Array) -> Iterator[tuple[int, list[int], list[int]]]:
        """Of each text: number of words, the hit words, the items that occur."""
        data, offsets = buffers(texts)
        for first, last in blocks(offsets):
            at = offsets[first : last + 1] - offsets[first]
            words = Words(data[offsets[first] : offsets[last]], at)
            hits: dict[int, tuple[set[int], set[int]]] = {}
            for n, (hashes, found) in self.by_length.items():
                seen = words.window_hash(n)
                near = hashes[np.minimum(np.searchsorted(hashes, seen), len(hashes) - 1)] == seen
                for j in np.flatnonzero(near & words.whole(n)).tolist():
                    items = found[int(seen[j])].get(words.joined(j, n))
                    if items:
                        i = int(np.searchsorted(words.first, j, side="right")) - 1
                        spots, ids = hits.setdefault(i, (set(), set()))
                        spots.update(range(j - int(words.first[i]), j - int(words.first[i]) + n))
                        ids.update(items)
            for i, n in enumerate(np.diff(words.first).tolist()):
                spots, ids = hits.get(i, ((), ()))
                yield n, sorted(spots), sorted(ids)


def item_blocks(benchmark: DataFrame, max_block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks whose size is checked before they come to the driver."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), text_of("text").alias("text"))
    total = items.agg(F.sum(F.octet_length("text") + F.lit(64))).first()[0] or 0
    n = -(-int(total) // max_block_bytes)
    for i in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        yield [(r.item_id, r.text) for r in part.collect()]


def _hits_udf(shared: Broadcast, positions: bool):
    @F.arrow_udf(HITS)
    def hits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = shared.value
        for texts in batches:
            rows = list(index.scan(texts))
            yield pa.StructArray.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([len(r[1]) for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                    pa.array([r[1] if positions else [] for r in rows], pa.list_(pa.int32())),
                ],
                ["n_words", "n_hit", "items", "hit_words"],
            )

    return hits


def scan_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_block_bytes: int = MAX_BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (ids of items with occurring windows)."""
    found = item_blocks(benchmark, max_block_bytes)
    first, second = next(found, []), next(found, None)
    rows = docs.select("doc_id", text_of("text").alias("text"))
    if second is None:
        udf = _hits_udf(_shared(docs, first, window), False)
        return rows.select("doc_id", udf("text").alias("h")).select("doc_id", "h.n_words", "h.n_hit", "h.items")
    keyed = checkpointed(rows.withColumn(ROW, F.monotonically_increasing_id()))
    united = _united(keyed, _all(first, second, found), window, ["doc_id"], True)
    return united.select("doc_id", "n_words", F.size("hit_words").cast("bigint").alias("n_hit"), "items")


def _shared(docs: DataFrame, items: list[tuple[int, str]], window: int) -> Broadcast:
    return docs.sparkSession.sparkContext.broadcast(WindowIndex(items, window))


def _all(first: list, second: list, rest: Iterator[list]) -> Iterator[list]:
    yield first
    yield second
    yield from rest


def _united(rows: DataFrame, found: Iterator[list], window: int, columns: list[str], keep_clean: bool) -> DataFrame:
    """A row for each row with hits (or with ``keep_clean`` for each row): its key and ``columns``, n_words, items and hit_words of all blocks.

    The hits of one block are written, and its index is given up, before the next is built."""
    parts = []
    for i, items in enumerate(found):
        shared = _shared(rows, items, window)
        each = rows.select(ROW, *columns, _hits_udf(shared, True)("text").alias("h")).select(ROW, *columns, "h.*")
        parts.append(checkpointed(each if keep_clean and not i else each.filter("n_hit > 0")))
        shared.destroy()
    united = reduce(DataFrame.unionByName, parts)
    return united.groupBy(ROW).agg(
        *[F.first(c).alias(c) for c in columns],
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_words")))).alias("hit_words"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW, max_block_bytes: int = MAX_BLOCK_BYTES) -> DataFrame:
    """The documents without hit ones (``remove="documents"``) or without the hit words (``"spans"``).

    All columns stay, extra ones too, and rows of null doc_id like any others. A span runs from the first to the
    last of adjoining hit words; what stood between words outside a span stays. Documents are dropped, and spans
    cut, once, by the united hits of all blocks.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is 'documents' or 'spans', not {remove!r}")
    found = item_blocks(benchmark, max_block_bytes)
    first, second = next(found, None), next(found, None)
    if first is None:
        return docs
    if second is None:
        hits = _hits_udf(_shared(docs, first, window), remove == "spans")(text_of("text"))
        return docs.filter(hits.getField("n_hit") == 0) if remove == "documents" else docs.withColumn("text", _cut("text", hits.getField("hit_words")))
    rows = checkpointed(docs.withColumn(ROW, F.monotonically_increasing_id()))
    hit = _united(rows.withColumn("text", text_of("text")), _all(first, second, found), window, [], False)
    if remove == "documents":
        return rows.join(hit.select(ROW), ROW, "left_anti").select(*docs.columns)
    spots = hit.select(ROW, F.col("hit_words").alias(SPOTS))
    cut = rows.join(spots.hint("merge"), ROW, "left").withColumn("text", F.when(F.col(SPOTS).isNull(), F.col("text")).otherwise(_cut("text", SPOTS)))
    return cut.select(*docs.columns)


@F.arrow_udf(T.StringType())
def _cut(texts: pa.Array, spots: pa.Array) -> pa.Array:
    """Texts without the words at the sorted positions ``spots``."""
    out = []
    for text, at_words in zip(texts.to_pylist(), spots.to_pylist(), strict=True):
        if at_words:
            raw = text.encode()
            words = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
            keep, at = [], 0
            for group in np.split(np.array(at_words), np.flatnonzero(np.diff(at_words) > 1) + 1):
                keep.append(raw[at : words.start[group[0]]])
                at = int(words.end[group[-1]])
            text = b"".join([*keep, raw[at:]]).decode()
        out.append(text)
    return pa.array(out, pa.string())

def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP2_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS n, array_to_string(words[i : i + least(10, len(words)) - 1], ' ') AS win
  FROM (SELECT item_id, words, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i FROM b WHERE len(words) > 0)
), dw AS (
  SELECT doc_id, n, i, array_to_string(words[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM w, (SELECT DISTINCT n FROM bw) WHERE len(words) >= n)
), hit AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hit) GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""
