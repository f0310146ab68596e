"""Near-duplicates by ProbMinHash: sketches of shingles, banding, exact verification, components.

A shingle is five consecutive words (ASCII letters lower-cased); a text of fewer words, but not none, is one
shingle. Each distinct one weighs 1, however often it occurs, for the contract is Jaccard of sets. Each is a
Poisson process with that rate: it arrives
again and again, each time at a random register, and a register keeps the shingle that came first. A shingle
stops once it can no longer be first anywhere, so most stop after one arrival. Registers of two texts agree
with the probability Jaccard of their weights, which is the plain Jaccard of the sets.

1. Texts of the same words fall into one class at once (its smallest doc_id represents it).
2. Representatives meet in buckets, one for each band of registers. No bucket is spread into pairs: each
   member meets the hub alone (the member whose own buckets hold the most texts: of edited copies, the
   original), and what meets in several bands is one pair. Pairs whose registers agree too rarely for the
   threshold (by over five standard deviations, one in 10^8) are left; all others are verified: Jaccard of
   the two sets of shingles of the whole texts. The links make components.
3. A bucket that still holds several components is open, and the members outside the largest of them are its
   strays. While strays times members, over all open buckets, exceed ``TILE_WORK`` for each member, rounds of
   leaders go on: each stray meets some random members. A round is linear in the members, and the next one
   has fewer strays; rounds end when one no longer pays.
4. The rest is exact: each stray is compared with all members of other components of its bucket, first by
   registers, then by sets. Tiles of both sides spread this over tasks, and a tile gives a link at most for
   each text and component. So two texts that share a bucket and are similar enough are always in one class.

Texts without words are near-duplicates of nothing. One document of each class stays: the smallest doc_id.
Repeated rows share a class, and one of them stays. Sizes of classes are not bounded, and no class meets in
one task. Where some doc_id is null or stands in several rows (with one text or with several), rows are
compared by a number of their own, with the same result. A null id represents a class, as the only row that
stays, if no text in it has an id: its class_id is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lorebank.llm.common import Words, blocks, buffers, mixed, table, text_of
from lorebank.llm.components import components
from lorebank.llm.scratch import checkpointed

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 20, 4
REGISTERS = BANDS * ROWS
#: Comparisons for each member of an open bucket up to which tiles compare all strays; random members that a
#: stray meets in a round of leaders; and the share of strays that a round must link to be followed by another.
TILE_WORK, LEADERS, LEAST_GAIN = 1000, 8, 0.1
#: Members and bytes of shingles of one side of a tile.
TILE_MEMBERS, TILE_BYTES = 512, 4 << 20
#: Share of agreeing registers under which a pair is not verified.
LEAST_AGREEMENT = 0.55
#: Number of a row, no column of the documents.
ROW = "_lorebank_row"

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: Words, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of a block: text, 44-bit hash, times. In order of text and hash."""
    counts = np.diff(words.first)
    owner = words.owner()
    keys = []
    for k in range(1, n + 1):
        if k < n and not (counts == k).any():
            continue
        h = words.window_hash(k)
        take = words.whole(k) & (counts[owner] >= n if k == n else counts[owner] == k)
        keys.append((owner[take].astype(np.uint64) << np.uint64(44)) | (h[take] >> np.uint64(20)))
    key = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    times = np.diff(np.concatenate([at, [len(key)]]))
    key = key[at]
    return (key >> np.uint64(44)).astype(np.int64), key & np.uint64((1 << 44) - 1), times


def prob_min_hash(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """Registers of n texts, from their weighted shingles: an array of n rows of m unsigned 32-bit values."""
    time = np.full(n * m, np.inf)
    kept = np.zeros(n * m, np.uint64)
    element = mixed(shingle + _GOLDEN)
    now, rate, row = np.zeros(len(text)), weight, text
    turn = 0
    while len(row):
        turn += 1
        draw = mixed(element ^ mixed(np.uint64(turn)))
        now = now - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
        slot = row * m + (mixed(draw) % np.uint64(m)).astype(np.int64)
        np.minimum.at(time, slot, now)
        first = time[slot] == now
        kept[slot[first]] = element[first]
        latest = time.reshape(n, m).max(axis=1)
        on = now < latest[row]
        row, now, rate, element = row[on], now[on], rate[on], element[on]
    return (kept >> np.uint64(32)).astype(np.uint32).reshape(n, m)


SKETCH = T.StructType().add("key1", T.LongType()).add("key2", T.LongType()).add("registers", T.BinaryType())


@F.arrow_udf(SKETCH)
def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """128 bits of the sequence of words, and the registers; nulls for a text without words."""
    for texts in batches:
        data, offsets = buffers(texts)
        key1, key2, out = [], [], []
        for a, b in blocks(offsets):
            words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            n, counts = b - a, np.diff(words.first)
            row, shingle, _ = shingles(words)
            registers = prob_min_hash(row, shingle, np.ones(len(row)), n)
            place = np.arange(len(words.start)) - np.repeat(words.first[:-1], counts)
            for seed, keys in ((1, key1), (2, key2)):
                total = np.zeros(len(words.start) + 1, np.uint64)
                np.cumsum(mixed(words.hash + mixed(place.astype(np.uint64) * np.uint64(2) + np.uint64(seed))), out=total[1:])
                keys.extend((total[words.first[1:]] - total[words.first[:-1]]).view(np.int64).tolist())
            out.extend(r.tobytes() if c else None for r, c in zip(registers, counts.tolist()))
        none = pa.array([r is None for r in out], pa.bool_())
        nulls = pa.nulls(len(out), pa.int64())
        yield pa.StructArray.from_arrays(
            [pc.if_else(none, nulls, pa.array(key1, pa.int64())), pc.if_else(none, nulls, pa.array(key2, pa.int64())), pa.array(out, pa.binary())], ["key1", "key2", "registers"]
        )


@F.arrow_udf(T.DoubleType())
def agreement(a: pa.Array, b: pa.Array) -> pa.Array:
    """Share of registers that agree."""
    x = np.frombuffer(b"".join(a.to_pylist()), np.uint32).reshape(-1, REGISTERS)
    y = np.frombuffer(b"".join(b.to_pylist()), np.uint32).reshape(-1, REGISTERS)
    return pa.array((x == y).mean(axis=1) if len(x) else np.zeros(0))


def _set(raw: pa.Scalar) -> np.ndarray:
    return np.frombuffer(raw.as_buffer(), np.uint64)


@F.arrow_udf(T.DoubleType())
def jaccard(a: pa.Array, b: pa.Array) -> pa.Array:
    """Exact Jaccard of two sets of shingles."""
    out = []
    for x, y in zip(map(_set, a), map(_set, b)):
        common = len(np.intersect1d(x, y, assume_unique=True))
        union = len(x) + len(y) - common
        out.append(common / union if union else 0.0)
    return pa.array(out, pa.float64())


@F.arrow_udf(T.BinaryType())
def shingle_set(texts: pa.Array) -> pa.Array:
    """The sorted 44-bit hashes of the shingles of each text."""
    out = []
    data, offsets = buffers(texts)
    for a, b in blocks(offsets):
        row, shingle, _ = shingles(Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
        at = np.searchsorted(row, np.arange(b - a + 1))
        out.extend(shingle[at[i] : at[i + 1]].tobytes() for i in range(b - a))
    return pa.array(out, pa.binary())


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _tile(rows: pa.Table) -> pa.Table:
    """Links of the queries of a tile to its members: at most one for each query and component."""
    queries, members = rows.filter(pc.field("query")), rows.filter(~pc.field("query"))
    if not len(queries) or not len(members):
        return _LINKS.empty_table()
    sketches = lambda t: np.frombuffer(b"".join(t["registers"].to_pylist()), np.uint32).reshape(-1, REGISTERS)
    own, theirs = sketches(queries), sketches(members)
    rep, part = members["rep"].to_numpy(), members["part"].to_numpy()
    sets = [_set(x) for x in members["shingles"].combine_chunks()]
    out: list[tuple[int, int]] = []
    for i, (node, own_part, raw) in enumerate(zip(queries["rep"].to_pylist(), queries["part"].to_pylist(), queries["shingles"].combine_chunks())):
        near = ((theirs == own[i]).sum(axis=1) >= LEAST_AGREEMENT * REGISTERS) & (part != own_part)
        own_set, met = _set(raw), set()
        for j in np.flatnonzero(near).tolist():
            if part[j] in met:
                continue
            common = len(np.intersect1d(own_set, sets[j], assume_unique=True))
            if common >= THRESHOLD * (len(own_set) + len(sets[j]) - common):
                met.add(part[j])
                out.append((node, int(rep[j])))
    return pa.Table.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], schema=_LINKS)


def _tiled(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between components of the open buckets. members: bucket, rep, part, stray; sets: rep, registers, shingles."""
    sized = members.join(sets.select("rep", F.octet_length("shingles").alias("size")), "rep")

    def tiles(which) -> F.Column:
        count, size = F.sum(which.cast("bigint")), F.sum(F.when(which, F.col("size").cast("bigint")).otherwise(0))
        return F.greatest(F.lit(1), F.ceil(count / TILE_MEMBERS), F.ceil(size / TILE_BYTES)).cast("int")

    cuts = checkpointed(sized.groupBy("bucket").agg(tiles(F.col("stray")).alias("down"), tiles(F.lit(True)).alias("across")))
    cut = members.join(cuts, "bucket")

    def side(rows: DataFrame, own: str, other: str, query: bool) -> DataFrame:
        spot = F.pmod(F.xxhash64("rep", F.lit(own)), F.col(own)).cast("int").alias(own)
        return rows.select("bucket", "rep", "part", spot, F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other), F.lit(query).alias("query"))

    both = side(cut.filter("stray"), "down", "across", True).unionByName(side(cut, "across", "down", False))
    return both.join(sets, "rep").groupBy("bucket", "down", "across").applyInArrow(_tile, "a bigint, b bigint").distinct()


def _members(reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Buckets of several members: (bucket, rep), and (bucket, hub, size). reps: rep, registers."""
    width = ROWS * 4
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("registers", i * width + 1, width)) for i in range(BANDS)])
    rows = reps.select("rep", F.explode(keys).alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = checkpointed(rows.join(sizes, "bucket"))
    degree = members.groupBy("rep").agg(F.sum("size").alias("degree"))
    # Written, so that the join with a bucket's members can be split where one bucket is hot.
    hubs = members.join(degree, "rep").groupBy("bucket").agg(F.max(F.struct("degree", "rep")).getField("rep").alias("hub"), F.max("size").alias("size"))
    return members.select("bucket", "rep"), checkpointed(hubs)


def _ordered(one: str, other: str) -> list[F.Column]:
    return [F.greatest(one, other).alias("a"), F.least(one, other).alias("b")]


def _likely(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (a, b), each once, whose registers agree often enough to be verified."""
    left = pairs.distinct().join(reps.select(F.col("rep").alias("a"), F.col("registers").alias("ra")), "a")
    both = left.join(reps.select(F.col("rep").alias("b"), F.col("registers").alias("rb")), "b")
    return both.filter(agreement("ra", "rb") >= LEAST_AGREEMENT).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose texts are similar enough; those with many partners are split by AQE's skew join."""
    left = pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa")), "a")
    both = left.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb")), "b")
    return both.filter(jaccard("sa", "sb") >= THRESHOLD).select("a", "b")


def _joined(whole: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, component) and more links: the components of both."""
    return whole if links.isEmpty() else components(whole.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links))


def _open(large: DataFrame, whole: DataFrame) -> DataFrame:
    """Members of buckets that hold several components: bucket, rep, part, stray, n (members of the bucket)."""
    placed = large.join(whole.withColumnRenamed("node", "rep"), "rep", "left").select("bucket", "rep", F.coalesce("component", "rep").alias("part"))
    parts = placed.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("k"))
    several = parts.groupBy("bucket").agg(F.max(F.struct("k", "part")).getField("part").alias("main"), F.count(F.lit(1)).alias("parts"), F.sum("k").alias("n")).filter("parts > 1")
    # Written, so that the join can be split where one bucket is hot.
    return checkpointed(placed.join(checkpointed(several.select("bucket", "main", "n")), "bucket").select("bucket", "rep", "part", (F.col("part") != F.col("main")).alias("stray"), "n"))


def _led(members: DataFrame, turn: int) -> DataFrame:
    """Strays and some random members of their buckets, as pairs."""
    some = [F.min(F.struct(F.xxhash64("rep", "bucket", F.lit(turn), F.lit(i)), "rep", "part")) for i in range(LEADERS)]
    leads = checkpointed(members.groupBy("bucket").agg(F.array(*some).alias("leads")))
    met = members.filter("stray").join(leads, "bucket").select("rep", "part", F.explode("leads").alias("lead"))
    return met.filter(F.col("part") != F.col("lead.part")).select("rep", F.col("lead.rep").alias("other")).select(*_ordered("rep", "other"))


def _rest(large: DataFrame, whole: DataFrame, reps: DataFrame, sets: DataFrame, work: int = TILE_WORK) -> DataFrame:
    """Components after all members of large buckets have met. large: bucket, rep."""
    turn, before = 0, None
    while True:
        members = _open(large, whole)
        left = members.agg(F.count_if("stray").alias("strays"), F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("stray"), F.col("n").cast("double"))).alias("pairs")).first()
        if not left["strays"]:
            return whole
        if left["pairs"] <= work * left["n"] or (before is not None and left["strays"] > (1 - LEAST_GAIN) * before):
            return _joined(whole, checkpointed(_tiled(members, sets)))
        turn, before = turn + 1, left["strays"]
        whole = _joined(whole, checkpointed(_verified(_likely(_led(members, turn), reps), sets)))


def _classes(docs: DataFrame) -> DataFrame:
    """Classes of documents whose doc_id is never null and never repeats."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of("text").alias("text"))
    sketches = checkpointed(texts.select("doc_id", sketch("text").alias("s")).select("doc_id", "s.*"))
    worded = sketches.filter(F.col("registers").isNotNull())
    reps = checkpointed(worded.groupBy("key1", "key2").agg(F.min(F.struct("doc_id", "registers")).alias("m")).select("key1", "key2", F.col("m.doc_id").alias("rep"), F.col("m.registers").alias("registers")))
    side = reps.select("rep", "registers")
    members, hubs = _members(side)
    pairs = checkpointed(_likely(members.join(hubs, "bucket").filter("rep <> hub").select(*_ordered("rep", "hub")), side))
    # Two members have met when each has met the hub; all larger buckets may have to be gone through.
    large = checkpointed(members.join(hubs.filter("size > 2").select("bucket"), "bucket").select("bucket", "rep"))
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).union(large.select("rep")).distinct()
    # The ids of candidates grow with the input: this join is shuffled at every size.
    sets = texts.join(wanted.hint("merge"), "doc_id").select(F.col("doc_id").alias("rep"), shingle_set("text").alias("shingles"))
    sets = checkpointed(sets.join(side, "rep"))
    whole = _rest(large, components(checkpointed(_verified(pairs, sets))), side, sets)
    owner = reps.select("key1", "key2", "rep").join(whole, F.col("rep") == F.col("node"), "left").select("key1", "key2", F.coalesce("component", "rep").alias("class"))
    out = sketches.select("doc_id", "key1", "key2").join(owner, ["key1", "key2"], "left")
    return out.select("doc_id", F.coalesce("class", "doc_id").alias("class_id")).withColumn("kept", F.col("doc_id") == F.col("class_id"))


def _own_ids(docs: DataFrame) -> bool:
    """Whether each row has an id of its own."""
    return docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | F.col("doc_id").isNull()).isEmpty()


def _numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with a number in ROW, written once, and by ROW their doc_id, class_id and kept."""
    rows = checkpointed(docs.withColumn(ROW, F.monotonically_increasing_id()))
    found = checkpointed(_classes(rows.select(F.col(ROW).alias("doc_id"), "text")).select(F.col("doc_id").alias(ROW), F.col("class_id").alias("group")))
    ids = found.join(rows.select(ROW, F.col("doc_id").cast("bigint").alias("doc_id")), ROW)
    leads = checkpointed(ids.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW)).alias("lead")))
    return rows, ids.join(leads, "group").select(ROW, "doc_id", F.col("lead.doc_id").alias("class_id"), (F.col(ROW) == F.col("lead")[ROW]).alias("kept"))


def near_classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its class), kept."""
    return _classes(docs) if _own_ids(docs) else _numbered(docs.select("doc_id", "text"))[1].drop(ROW)


def near_dedup(docs: DataFrame) -> DataFrame:
    """The documents that stay, one of each class, with all their columns."""
    if not _own_ids(docs):
        rows, classes = _numbered(docs)
        return rows.join(classes.filter(~F.col("kept")).select(ROW).hint("merge"), ROW, "left_anti").select(*docs.columns)
    gone = _classes(docs).filter(~F.col("kept")).select("doc_id")
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))
