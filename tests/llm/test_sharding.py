import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lorebank.llm.sharding import Cells, find_cuts, plan_cuts, sharded
from tests.llm.helpers import SCHEMA, clashing, frame, rows


def least_capacity(sizes, shards):
    low, high = 0, sum(sizes)
    while low < high:
        mid, n, held = (low + high) // 2, 1, 0
        for s in sizes:
            n, held = (n + 1, s) if held + s > mid else (n, held + s)
        if max(sizes) <= mid and n <= shards:
            high = mid
        else:
            low = mid + 1
    return low


@pytest.mark.parametrize("bits", [4, 7, 15])
@pytest.mark.parametrize("shards", [3, 24])
def test_capacity_is_the_smallest(spark, bits, shards):
    docs = rows(n=200)
    out = sharded(clashing(frame(spark, docs)), shards, bits).collect()
    text = {d: t or "" for d, t, *_ in docs}
    assert len(out) == len(docs) and all(r.size == len(text[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in out)
    load, slots, where = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in out:
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
        where[text[r.doc_id]].add(r.shard)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in where.values())
    groups = frame(spark, docs).groupBy(F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 8).alias("s")).orderBy("h")
    assert max(load.values()) == least_capacity([r.s for r in groups.collect()], shards)


def test_one_group_with_a_third_of_all_rows(spark):
    docs = [(i, f"text {i} " * 5, "en", "s", 0) for i in range(200)] + [(1000 + i, "copy", "en", "s", 0) for i in range(100)]
    out = sharded(frame(spark, docs), 4).collect()
    assert len({r.shard for r in out if r.doc_id >= 1000}) == 1
    assert {r.shard for r in out} <= set(range(4))


def test_empty_table(spark):
    assert sharded(frame(spark, [], SCHEMA, 1)).count() == 0


def test_cells_are_split_until_exact():
    cells = Cells([(0, 10, True, 3), (8, 10, False, 3), (16, 10, True, 3)])
    assert plan_cuts(cells, 2)[2] == {1}
    exact = Cells([(0, 10, True, 3), (8, 3, True, 4), (12, 7, True, 4), (16, 10, True, 3)])
    assert plan_cuts(exact, 2) == (17, [13], set())


def test_find_cuts(spark):
    df = spark.createDataFrame([(h, 1) for h in range(-50, 50)], "h bigint, size bigint")
    assert find_cuts(df, 4, 4) == (25, [-25, 0, 25])
