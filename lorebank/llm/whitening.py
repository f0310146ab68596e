"""Whitening of embeddings by matrix-free block Lanczos.

Entries are quantised to whole numbers, so counts, sums and deviations are exact. The covariance of the distinct
vectors (the fit list) is never formed: a pass over the written fit list gives the centred products X'(XV) of a
block of directions V, summed up by Spark; only blocks of ``dim`` by ``width`` numbers meet at the driver. Each
new block is orthogonalised against all earlier ones, twice. Directions that vanish (breakdown) are replaced by
random ones; a basis that would outgrow its bound restarts from its best Ritz vectors. It ends when the residuals
of all wanted pairs are small, or the basis spans the space. The trace comes from the deviations of the same pass.

Dropped: null vectors, vectors with null or non-finite entries, and those whose number of entries is not the most
frequent one (of ties the largest). Entries beyond 2^55 are taken as 2^55. Rows are independent: repeated rows, ties
and null ids keep their rows. Components whose eigenvalue is zero (up to rounding) cannot be whitened and are left
out, so a table of one distinct vector, like an empty one, gives an empty result. A deviation beyond the range of
long is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorebank.llm.common import table
from lorebank.llm.scratch import checkpointed

COMPONENTS = 16
#: Directions of a block besides the wanted ones; no eigenspace among the wanted can be wider than a block.
EXTRA = 4
#: Blocks in the basis before it restarts.
MOST_BLOCKS = 8
#: Residuals of the wanted pairs, relative to the largest eigenvalue.
TOLERANCE = 1e-13
#: Eigenvalues below this share of the largest are zero.
ZERO = 1e-12
SCALE, SHIFT = 64, 1_000_000
#: Entries that one product of matrices handles.
TILE = 1 << 20

Apply = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: rows of ``vectors`` are unit eigenvectors by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float
    passes: int


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The rows of a column of lists, all of dim entries."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def dimension(rows: DataFrame, column: str) -> int:
    """The most frequent number of entries; 0 without vectors."""
    sizes = rows.filter(F.col(column).isNotNull()).groupBy(F.size(column).alias("d")).count()
    found = sizes.orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return found[0].d if found else 0


def quantised(rows: DataFrame, column: str, dim: int) -> DataFrame:
    """The usable rows, with the whole numbers ``x`` in place of ``column``."""
    kept = [c for c in rows.columns if c not in (column, "x")]
    schema = pa.schema([*_arrow_fields(rows, kept), ("x", pa.list_(pa.int64()))])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.equal(pc.list_value_length(batch.column(column)), dim))
            values = pc.fill_null(batch.column(column).flatten().cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False).reshape(batch.num_rows, dim)
            good = np.isfinite(values).all(axis=1)
            x = np.floor(np.clip(SCALE * values[good], -(2.0**55), 2.0**55)).astype(np.int64) + SHIFT
            out = batch.filter(pa.array(good))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * dim, pa.int32()), pa.array(x.ravel()))
            yield pa.record_batch([*(out.column(c).cast(schema.field(c).type) for c in kept), lists], schema=schema)

    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema), "x array<bigint>"])
    return rows.select(*kept, column).mapInArrow(coded, fields)


def _arrow_fields(rows: DataFrame, names: list[str]) -> list[tuple[str, pa.DataType]]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [(f.name, to_arrow_type(f.dataType)) for f in rows.select(*names).schema]


def _summed(fit: DataFrame, dim: int, size: int, of: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """The sum of ``of(x)`` (``size`` numbers for a matrix of rows) over the whole table: each task adds up its own, Spark the tasks'."""
    number = pa.int64() if kind == "bigint" else pa.float64()

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, step = np.zeros(size, np.int64 if kind == "bigint" else np.float64), max(1, TILE // dim)
        any_rows = False
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            for i in range(0, len(x), step):
                total += of(x[i : i + step])
                any_rows = True
        if any_rows:
            yield pa.record_batch([pa.array(np.arange(size), pa.int32()), pa.array(total, number)], names=["i", "v"])

    rows = fit.select("x").mapInArrow(parts, f"i int, v {kind}").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size, np.int64 if kind == "bigint" else np.float64)
    for r in rows:
        out[r.i] = r.v
    return out


def _orthogonal(block: np.ndarray, basis: np.ndarray, rng: np.random.Generator, scale: float) -> np.ndarray:
    """Unit directions of ``block`` outside the basis; those that vanish are drawn anew, as far as the space has room."""
    dim, width = basis.shape[0], min(block.shape[1], basis.shape[0] - basis.shape[1])
    own = np.zeros((dim, 0))
    columns = [block[:, i] for i in range(block.shape[1])]
    while own.shape[1] < width:
        fresh = not columns
        v = rng.standard_normal(dim) if fresh else columns.pop(0)
        size = np.linalg.norm(v)
        for _ in range(2):
            for q in (basis, own):
                v = v - q @ (q.T @ v)
        left = np.linalg.norm(v)
        if left > (1e-8 * size if fresh else 1e-10 * max(scale, size)) and left > 0:
            v /= left
            for q in (basis, own):
                v = v - q @ (q.T @ v)
            own = np.column_stack([own, v / np.linalg.norm(v)])
    return own


def block_lanczos(apply: Apply, dim: int, wanted: int, width: int, most: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
    """The largest eigenvalues of a symmetric operator, falling, their unit vectors as rows, and the passes taken.

    ``apply`` gives the operator's product with a block of columns; ``most`` bounds the columns of the basis.
    """
    rng = np.random.default_rng(seed)
    wanted, most = min(wanted, dim), min(dim, max(most, 3 * width))
    basis, images = np.zeros((dim, 0)), np.zeros((dim, 0))
    block, passes, best, stalled = _orthogonal(rng.standard_normal((dim, width)), basis, rng, 0.0), 0, np.inf, 0
    while True:
        image = apply(block)
        passes += 1
        basis, images = np.column_stack([basis, block]), np.column_stack([images, image])
        small = basis.T @ images
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, ritz_images = basis @ turn[:, :wanted], images @ turn[:, :wanted]
        rest = ritz_images - ritz * values[:wanted]
        worst = np.linalg.norm(rest, axis=0).max() / max(values[0], np.finfo(float).tiny)
        stalled = 0 if worst < best / 2 else stalled + 1
        best = min(best, worst)
        enough = basis.shape[1] >= wanted and (worst <= TOLERANCE or stalled >= 2 * MOST_BLOCKS)
        if enough or basis.shape[1] == dim:
            return values[:wanted], ritz.T, passes
        following = image
        if basis.shape[1] + width > most and basis.shape[1] < dim and most < dim:
            keep = min(wanted + width, most - width)
            following = np.column_stack([rest, image])[:, :width]
            basis, images = basis @ turn[:, :keep], images @ turn[:, :keep]
        block = _orthogonal(following, basis, rng, values[0] * 1e-3)


def fit_whitening(fit: DataFrame, dim: int, components: int = COMPONENTS, extra: int = EXTRA) -> Whitening | None:
    """Of a table of distinct vectors ``x``, which is read once a pass; None if they do not vary."""
    counts = _summed(fit, dim, dim + 1, lambda x: np.append(x.sum(axis=0), len(x)), "bigint").tolist()
    sums, n = counts[:-1], counts[-1]
    if n < 2:
        return None
    mean = np.array([s / n for s in sums])
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([s % n / n for s in sums])  # x - mean without the digits that they share

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - whole) - part

    trace = [0.0]

    def apply(v: np.ndarray) -> np.ndarray:
        def of(x: np.ndarray) -> np.ndarray:
            c = centred(x)
            return np.append((c.T @ (c @ v)).ravel(), np.vdot(c, c))

        out = _summed(fit, dim, v.size + 1, of, "double")
        trace[0] = out[-1] / n
        return out[:-1].reshape(v.shape) / n

    width = min(dim, components + extra)
    values, vectors, passes = block_lanczos(apply, dim, components, width, MOST_BLOCKS * width)
    if trace[0] <= 0:
        return None
    real = values > ZERO * values[0]
    values, vectors = values[real], vectors[real]
    vectors = vectors * np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=1)[:, None], 1) < 0, -1.0, 1.0)
    k, scaled = len(values), (vectors / np.sqrt(values)[:, None]).T

    def moments(x: np.ndarray) -> np.ndarray:
        z = centred(x) @ scaled
        return np.append((z.T @ z).ravel(), z.sum(axis=0))

    found = _summed(fit, dim, k * k + k, moments, "double") / n
    means = found[k * k :]
    error = float(np.abs(found[: k * k].reshape(k, k) - np.outer(means, means) - np.eye(k)).max())
    return Whitening(n, sums, values, vectors, trace[0], error, passes + 2)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Of each row the sum of (n * x - S)^2, exactly; None beyond long."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]
    near = x - whole
    largest = (int(np.abs(near).max(initial=0)) + 1) * n
    if largest * largest * x.shape[1] < 1 << 63:
        return ((near * n - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
    out = [sum((n * v - r) ** 2 for v, r in zip(row, rest)) for row in near.tolist()]
    return [v if v < 1 << 63 else None for v in out]


def whitened(rows: DataFrame, fit: Whitening | None, dim: int) -> DataFrame:
    """rows (with ``x``), a row for each component: component, n, deviation, whitened, explained, identity_error."""
    kept = [c for c in rows.columns if c != "x"]
    own = [("component", pa.int32(), "int"), ("n", pa.int64(), "bigint"), ("deviation", pa.int64(), "bigint"), ("whitened", pa.float64(), "double"), ("explained", pa.float64(), "double"), ("identity_error", pa.float64(), "double")]
    kept = [c for c in kept if c not in {name for name, *_ in own}]
    schema = pa.schema([*_arrow_fields(rows, kept), *((a, b) for a, b, _ in own)])

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(fit.values)
        whole, part = np.array([s // fit.n for s in fit.sums], np.int64), np.array([s % fit.n / fit.n for s in fit.sums])
        scaled, shares = (fit.vectors / np.sqrt(fit.values)[:, None]).T, fit.values / fit.trace
        step = max(1, TILE // (dim + k))
        for batch in batches:
            for i in range(0, batch.num_rows, step):
                tile = batch.slice(i, step)
                x = _matrix(tile.column(tile.num_columns - 1), dim)
                each = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.record_batch(
                    [
                        *(tile.column(c).take(each).cast(schema.field(c).type) for c in kept),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(x) * k, fit.n)),
                        pa.array(_deviations(x, fit.n, fit.sums), pa.int64()).take(each),
                        pa.array((((x - whole) - part) @ scaled).ravel()),
                        pa.array(np.tile(shares, len(x))),
                        pa.array(np.full(len(x) * k, fit.identity_error)),
                    ],
                    schema=schema,
                )

    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema), *(f"{a} {c}" for a, _, c in own)])
    if fit is None:
        return rows.sparkSession.createDataFrame([], fields)
    return rows.select(*kept, "x").mapInArrow(projected, fields)


def whiten(rows: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """All usable rows of a table, projected on the leading components of its distinct quantised vectors."""
    dim = dimension(rows, column)
    usable = quantised(rows, column, dim)
    fit = fit_whitening(checkpointed(usable.select("x").distinct()), dim, components) if dim else None
    return whitened(usable, fit, dim)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding"))
