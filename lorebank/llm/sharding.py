"""Sharding by minimax contiguous partition, with DataFrame functions only.

Atomic groups are equal texts, ordered by a 64-bit hash of the text; a shard is a run of that order. The
smallest capacity for which the runs fit is found by binary search; a capacity is checked greedily: each
shard takes groups as long as they fit. The checks need the sums of groups only near possible cuts. So Spark
first adds up sizes by the leading bits of the hash (a fixed number of cells comes to the driver); cells in
which a cut may fall are then split by further bits, until all cuts are exact. Neither groups nor documents
come to the driver, and no text is shuffled.

Among the cuts within the capacity those nearest to even shards are taken. Law ``bytes``: no shard holds
more than the smallest feasible capacity, and groups are never split. Null texts have no bytes and form one
group; an empty table gives an empty result. Rows that repeat a doc_id, and rows of a null one, get slots of their own.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lorebank.llm.common import table, text_of

SHARDS = 24
#: Bytes that a document has besides its text.
ROW_BYTES = 8
#: Cells that come to the driver at once, at most (a power of two).
CELL_BITS = 15
#: Documents that get their slots in one window, on average.
SLOT_ROWS = 20_000

_MIN = -(1 << 63)


class Cells:
    """Consecutive ranges of the hash: first hash, size, and whether they hold a single hash."""

    def __init__(self, cells: list[tuple[int, int, bool, int]]):
        self.cells = sorted(cells)  # first hash of the range, bytes, single, leading bits
        self.ends = list(accumulate(c[1] for c in self.cells))
        self.begins = [0, *self.ends[:-1]]
        self.total = self.ends[-1] if self.ends else 0

    def at(self, x: int) -> int:
        """The cell that holds byte x."""
        return bisect_right(self.ends, x)

    def floor(self, x: int) -> int:
        """The last known border at or before byte x."""
        return self.total if x >= self.total else self.begins[self.at(x)]

    def ceil(self, x: int) -> int:
        """The first known border at or after byte x."""
        return 0 if x <= 0 else self.ends[min(bisect_left(self.ends, x), len(self.ends) - 1)]

    def fluid(self, x: int) -> int:
        """The last border that may be at or before byte x: cells of several groups may have one anywhere."""
        if x >= self.total:
            return self.total
        i = self.at(x)
        return self.begins[i] if self.cells[i][2] else x

    def vague(self, x: int) -> set[int]:
        """The cell of byte x, if a border inside it may be missing."""
        if not 0 < x < self.total:
            return set()
        i = self.at(x)
        return {i} if not self.cells[i][2] and self.begins[i] != x else set()


def _reach(step, capacity: int, shards: int) -> list[int]:
    """Where the greedy shards end."""
    out, at = [], 0
    for _ in range(shards):
        at = step(at + capacity)
        out.append(at)
    return out


def _least(step, total: int, shards: int) -> int:
    """The smallest capacity at which greedy shards hold everything."""
    low, high = -(-total // shards), total
    while low < high:
        mid = (low + high) // 2
        if _reach(step, mid, shards)[-1] >= total:
            high = mid
        else:
            low = mid + 1
    return low


def plan_cuts(cells: Cells, shards: int) -> tuple[int, list[int], set[int]]:
    """Capacity, cuts in bytes, and the cells that must be split before these are exact."""
    total = cells.total
    if not total:
        return 0, [0] * (shards - 1), set()
    heavy = {i for i, c in enumerate(cells.cells) if not c[2] and c[1] * 4 * shards > total}
    if heavy:
        return 0, [], heavy
    above, below = _least(cells.floor, total, shards), _least(cells.fluid, total, shards)
    if above != below:
        vague: set[int] = set()
        for x, y in zip(_reach(cells.floor, below, shards), _reach(cells.fluid, above, shards)):
            vague |= {i for i in range(cells.at(x), min(cells.at(y), len(cells.cells) - 1) + 1) if not cells.cells[i][2]}
        return 0, [], vague
    # No shard may begin so early that the rest no longer fits behind it.
    vague, capacity, latest = set(), above, [total] * (shards + 1)
    for j in range(shards - 1, 0, -1):
        x = latest[j + 1] - capacity
        vague |= cells.vague(x)
        latest[j] = cells.ceil(x)
    cuts, at = [], 0
    for j in range(1, shards):
        even = total * j // shards
        vague |= cells.vague(even) | cells.vague(at + capacity)
        low, high = cells.floor(even), cells.ceil(even)
        near = low if even - low <= high - even else high
        at = max(latest[j], min(near, cells.floor(at + capacity)))
        cuts.append(at)
    return capacity, cuts, vague


def _cell_rows(rows: DataFrame, bits: int, within: list[int] | None = None, before: int = 0) -> list[tuple[int, int, bool, int]]:
    """Sums by the leading ``bits`` of the hash, of cells with ``before`` bits or of all."""
    lead = F.shiftright("h", 64 - bits)
    if within is not None:
        rows = rows.filter(F.shiftright("h", 64 - before).isin([x >> (64 - before) for x in within]))
    found = rows.groupBy(lead.alias("cell")).agg(F.sum("size").alias("size"), F.min("h").alias("a"), F.max("h").alias("b"))
    return [(r.a if r.a == r.b else r.cell << (64 - bits), r.size, r.a == r.b, bits) for r in found.collect()]


def find_cuts(rows: DataFrame, shards: int, cell_bits: int = CELL_BITS) -> tuple[int, list[int]]:
    """rows: h, size. The capacity, and the first hash of each shard but the first."""
    cells = Cells(_cell_rows(rows, cell_bits))
    while True:
        capacity, cuts, vague = plan_cuts(cells, shards)
        if not vague:
            break
        # Wide uncertainty: the largest cells first, so that what comes back stays bounded.
        split = sorted(vague, key=lambda i: -cells.cells[i][1])[: 1 << (cell_bits - 2)]
        more = max(1, cell_bits - max(1, len(split)).bit_length())
        kept = [c for i, c in enumerate(cells.cells) if i not in set(split)]
        for bits in sorted({cells.cells[i][3] for i in split}):
            own = [cells.cells[i][0] for i in split if cells.cells[i][3] == bits]
            kept += _cell_rows(rows, min(64, bits + more), own, bits)
        cells = Cells(kept)
    firsts = []
    for x in cuts:
        i = cells.at(x)
        firsts.append(cells.cells[i][0] if x < cells.total else None)
    return capacity, firsts


def sharded(docs: DataFrame, shards: int = SHARDS, cell_bits: int = CELL_BITS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = text_of("text")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
    ).persist(StorageLevel.MEMORY_AND_DISK)  # four numbers a document; a lost block is read anew
    _, firsts = find_cuts(rows, shards, cell_bits)
    shard = sum((F.when(F.col("h") >= F.lit(x), 1).otherwise(0) for x in firsts if x is not None), F.lit(0)).cast("int")
    count = rows.count()
    # Slots count up by part, and in a part by doc_id: no window holds a shard or a group of copies.
    parts = max(1, -(-count // (shards * SLOT_ROWS)))
    placed = rows.select("*", shard.alias("shard"), F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(parts)).cast("int").alias("part"))
    sizes = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")
    # As many rows as windows: shards times parts, one for each SLOT_ROWS documents.
    starts = sizes.select("shard", "part", before.alias("start"))
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "h")) - 1
    out = placed.withColumn("place", place).join(starts, ["shard", "part"])
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("start") + F.col("place")).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"))
