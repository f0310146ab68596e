import numpy as np
import pytest

from lorebank.llm.whitening import _deviations, block_lanczos, fit_whitening, quantised, whiten

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def vectors(n, dim, seed=0):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, dim)) * np.linspace(3, 0.1, dim)) @ np.linalg.qr(rng.standard_normal((dim, dim)))[0]


def frame(spark, data, parts=4):
    return spark.createDataFrame(data, SCHEMA).repartition(parts)


def whole(values):
    return [int(np.floor(64 * float(np.float32(v)))) + 1_000_000 for v in values]


@pytest.mark.parametrize("dim", [3, 24, 64])
def test_against_dense_eigenvectors(spark, dim):
    x = vectors(400, dim)
    data = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    data += [(1000 + i, x[7].tolist(), 1) for i in range(200)] + [data[3], (None, x[8].tolist(), 1)]  # copies count once
    bad = [(5000, None, 1), (5001, [None] + [1.0] * (dim - 1), 1), (5002, [float("nan")] * dim, 1), (5003, [float("inf")] * dim, 1), (5004, [], 1), (5005, [1.0] * (dim + 1), 1)]
    out = whiten(frame(spark, data + bad).selectExpr("*", "1 as n", "'a' as whitened")).collect()
    q = np.array(sorted({tuple(whole(v)) for _, v, _ in data}), dtype=object)
    n, sums = len(q), q.sum(axis=0)
    c = (q - np.array([float(s) / n for s in sums])).astype(float)
    values, vecs = np.linalg.eigh(c.T @ c / n)
    values, vecs = values[::-1], vecs[:, ::-1]
    k = min(16, dim)
    assert len(out) == len(data) * k and {r.n for r in out} == {n} and {r.component for r in out} == set(range(1, k + 1))
    by_id = {d: v for d, v, _ in data}
    for r in out:
        own = whole(by_id[r.vec_id])
        assert r.deviation == sum((n * a - int(s)) ** 2 for a, s in zip(own, sums))
        want = (np.array(own) - np.array([float(s) / n for s in sums])) @ vecs[:, r.component - 1] / np.sqrt(values[r.component - 1])
        assert abs(abs(r.whitened) - abs(want)) < 1e-8
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-10 and r.identity_error < 1e-8
    assert {r.vec_id for r in out} == set(by_id)


def test_one_sign_for_all_rows(spark):
    x = vectors(50, 8)
    out = whiten(frame(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)])).toPandas().pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(np.cov(out.T, bias=True) - np.eye(8)).max() < 1e-8


def test_restarts_and_breakdown():
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.standard_normal((300, 300)))[0]
    spread = np.concatenate([np.linspace(100, 40, 20), np.linspace(5, 0, 280)])
    for values in (spread, np.concatenate([np.full(40, 7.0), np.zeros(260)]), np.concatenate([[9.0, 4.0], np.zeros(298)])):
        a = (turn * values) @ turn.T
        a = (a + a.T) / 2
        got, vectors_, passes = block_lanczos(lambda v, a=a: a @ v, 300, 6, 8, 32)
        assert np.abs(got - np.sort(values)[::-1][:6]).max() < 1e-9
        assert np.abs(vectors_ @ vectors_.T - np.eye(6)).max() < 1e-12
        assert np.linalg.norm(a @ vectors_.T - vectors_.T * got) < 1e-9
        assert passes < 60


def test_vectors_that_do_not_vary(spark):
    same = frame(spark, [(i, [1.0, 2.0], 0) for i in range(5)])
    assert whiten(same).count() == 0
    assert whiten(frame(spark, [], 1)).count() == 0 and whiten(frame(spark, [(1, None, 0)], 1)).count() == 0
    flat = whiten(frame(spark, [(i, [float(i), 0.0, 2.0 * i], 0) for i in range(6)])).collect()  # rank 1
    assert {r.component for r in flat} == {1} and abs(flat[0].explained - 1) < 1e-9


def test_partitions_do_not_matter(spark):
    data = [(i, v.tolist(), 0) for i, v in enumerate(vectors(120, 20, 3))]
    runs = [{(r.vec_id, r.component): r.whitened for r in whiten(frame(spark, data, parts)).collect()} for parts in (1, 7)]
    assert max(abs(abs(runs[0][k]) - abs(runs[1][k])) for k in runs[0]) < 1e-9


def test_exact_deviations():
    x = np.array([[1_000_003, 999_990], [1_000_000, 1_000_001]], np.int64)
    assert _deviations(x, 2, [2_000_003, 1_999_991]) == [9 + 11**2, 9 + 11**2]
    assert _deviations(x * 10**6, 10**7, [10**19, 10**19]) == [None, None]


def test_whole_numbers(spark):
    df = quantised(frame(spark, [(1, [0.5, -0.01], 3), (2, [1e30, -1e30], 4)]), "embedding", 2)
    got = {r.vec_id: r.x for r in df.collect()}
    assert got[1] == [1_000_032, 999_999] and got[2] == [2**55 + 1_000_000, -(2**55) + 1_000_000] and df.columns == ["vec_id", "label", "x"]
    assert fit_whitening(df.select("x").limit(1), 2) is None
