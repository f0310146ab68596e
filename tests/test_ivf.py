import numpy as np
import pytest
from pyspark.sql import functions as F

from lorebank.operators import ivf
from lorebank.operators.vector import cosine_topk

KIND = "id bigint, embedding array<float>"


def table(spark, n=600, dim=12, groups=9, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((groups, dim)) * 3
    x = centers[rng.integers(groups, size=n)] + rng.standard_normal((n, dim)) * 0.6
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(n + i, x[5].tolist()) for i in range(4)]
    return spark.createDataFrame([*rows, (n + 10, None), (n + 11, [0.0] * dim)], KIND).repartition(4)


def plain(df):
    return sorted((r.query_id, r["rank"], r.id, round(r.similarity, 9)) for r in df.collect())


def asked(kb):
    return kb.filter("id % 20 = 0 or id >= 609").select(F.col("id").alias("query_id"), "embedding")


def test_all_lists_give_the_exact_result(spark, tmp_path):
    kb = table(spark)
    index = ivf.build_ivf(kb, str(tmp_path), 10)
    want = plain(cosine_topk(asked(kb), kb, 7))
    assert plain(ivf.ivf_search(asked(kb), index, 7, probes=10)) == want and len(want) > 200
    assert plain(ivf.ivf_search(asked(kb), index, 7, probes=99, block=8)) == want
    stored = spark.read.parquet(f"{tmp_path}/lists")
    assert stored.select("id").distinct().count() == 604  # all rows with a direction, some in two lists
    few = ivf.ivf_search(asked(kb), index, 7, probes=2)
    r = ivf.recall(few, asked(kb), kb, 7).first()
    assert r.wanted == len(want) and r.found == len(set((q, i) for q, _, i, _ in want) & {(x.query_id, x.id) for x in few.collect()}) and r.recall > 0.9


def test_rows_between_two_lists_lie_in_both(spark, tmp_path):
    kb = table(spark)
    n = lambda slack: (ivf.build_ivf(kb, f"{tmp_path}/{slack}", 10, slack), spark.read.parquet(f"{tmp_path}/{slack}/lists").count())[1]
    assert n(0.0) == 604 < n(1.5) <= 1208


def test_other_lists_are_not_read(spark, tmp_path):
    kb = table(spark)
    index = ivf.build_ivf(kb, str(tmp_path), 10)
    one = asked(kb).filter("query_id = 0")
    out = ivf.ivf_search(one, index, 3, probes=1)
    plan = out._jdf.queryExecution().toString()
    assert "PartitionFilters: [list" in plan.replace("isnotnull(list", "list").replace("[list#", "[list") or "list#" in plan.split("PartitionFilters")[1][:80]
    assert out.count() == 3


def test_built_again_and_empty(spark, tmp_path):
    kb = table(spark)
    index = ivf.build_ivf(kb.limit(0), str(tmp_path))
    assert ivf.ivf_search(asked(kb), index).count() == 0
    ivf.build_ivf(kb, str(tmp_path), 5)
    assert ivf.ivf_search(asked(kb), index, 2, 5).count() > 0 and index.state(spark)["lists"] == 5
    assert ivf.ivf_search(asked(kb).limit(0), index).count() == 0
    with pytest.raises(ValueError):
        ivf.ivf_search(asked(kb), ivf.VectorIndex(f"{tmp_path}/none"))
