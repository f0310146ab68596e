"""A stored approximate vector index: lists by centroid as folders, residual codes, exact scores for what they choose.

A row lies in its nearest list, and in the next one too where it lies between (``slack``). Of a row a list keeps a
code, a byte a dimension, of its distance from the centroid, beside the vector. A search reads the codes of the lists
that its queries probe (other folders are pruned), in Arrow blocks, and takes some rows a query by them; the vectors
are read for these rows only, and give exact similarities. As many probes as lists, with enough rows chosen, give
the exact result; ``recall`` tells what fewer give. All rows are indexed; centroids are fitted on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lorebank.operators.textindex import settled
from lorebank.operators.vector import ARROW, QUERY_BLOCK, ROW_TILE, _matrix, _unit, best_of, cosine, cosine_topk, query_blocks
from lorebank.sources import manifest

#: Rows of the sample for the centroids; rows of a list for each file over which it is spread.
SAMPLE, FILE_ROWS = 100_000, 50_000
#: A row lies between two lists where its distance from the second centroid is at most so many times the first's.
SLACK = 1.15
#: Rows chosen by their codes for each row asked for.
CHOSEN = 8


@dataclass(frozen=True)
class VectorIndex:
    root: str

    def state(self, spark: SparkSession) -> dict:
        found = manifest.latest(spark, self.root)
        if found is None:
            raise ValueError(f"no index in {self.root}")
        return found

    def centers(self, spark: SparkSession, state: dict) -> np.ndarray:
        """One centroid a row: as many as there are lists, whatever the rows."""
        rows = spark.read.schema("list int, center array<double>").parquet(f"{self.root}/centers/gen={state['gen']}").orderBy("list").collect()
        return np.array([r.center for r in rows])

    def rows(self, spark: SparkSession, state: dict) -> DataFrame:
        schema = f"id {state['id']}, code binary, embedding array<float>, list int"
        return spark.read.schema(schema).parquet(f"{self.root}/lists/gen={state['gen']}") if state["lists"] else spark.createDataFrame([], schema)


def _near(x: np.ndarray, centers: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the n nearest centroids, nearest first, and the distances."""
    far = np.sqrt(np.maximum((x**2).sum(axis=1)[:, None] + (centers**2).sum(axis=1)[None, :] - 2 * x @ centers.T, 0))
    at = np.argsort(far, axis=1, kind="stable")[:, :n]
    return at, np.take_along_axis(far, at, 1)


def build_ivf(kb: DataFrame, root: str, lists: int | None = None, slack: float = SLACK, sample: int = SAMPLE, seed: int = 7) -> VectorIndex:
    """kb: id, embedding; rows without a vector, or with one of zeros, are in no list. About the square root of the rows as lists."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    spark, kind = kb.sparkSession, kb.schema["id"].dataType.simpleString()
    rows = kb.filter(F.col("embedding").isNotNull() & F.exists("embedding", lambda v: v != 0)).select("id", F.col("embedding").cast("array<float>").alias("embedding"))
    before = manifest.latest(spark, root) or {}
    gen, n = before.get("version", 0) + 1, rows.count()
    state = {"version": gen - 1, "gen": gen, "id": kind, "lists": 0}
    if not n:
        manifest.commit(spark, root, state)
        return VectorIndex(root)
    share = min(1.0, sample / n)
    fitted = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select(array_to_vector(_unit("embedding")).alias("features"))
    centers = np.array(KMeans(k=min(n, lists or max(1, int(n**0.5))), seed=seed, maxIter=15).fit(fitted).clusterCenters())

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, ROW_TILE):
                batch = whole.slice(first, ROW_TILE)
                x = np.nan_to_num(_matrix(batch.column(1), centers.shape[1]))
                at, far = _near(x, centers, 2)
                keep = np.ones(at.shape, bool)
                keep[:, 1:] = far[:, 1:] <= slack * far[:, :1]
                row, place = np.nonzero(keep)
                own = at[row, place]
                code = np.clip(np.rint((x[row] - centers[own]) * 127), -127, 127).astype(np.int8)  # differences of unit vectors
                offsets = np.arange(len(row) + 1, dtype=np.int32) * code.shape[1]
                codes = pa.BinaryArray.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(offsets), pa.py_buffer(code.tobytes())])
                yield pa.record_batch([batch.column(0).take(pa.array(row)), codes, batch.column(1).take(pa.array(row)), pa.array(own, pa.int32())], names=["id", "code", "embedding", "list"])

    found = rows.mapInArrow(coded, f"id {kind}, code binary, embedding array<float>, list int")
    dealt = found.repartition("list", F.pmod(F.xxhash64("id"), F.lit(max(1, -(-n // (len(centers) * FILE_ROWS)))))).sortWithinPartitions("list", "id")
    dealt.write.mode("overwrite").partitionBy("list").parquet(f"{root}/lists/gen={gen}")
    spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centers)], "list int, center array<double>").coalesce(1).write.mode("overwrite").parquet(f"{root}/centers/gen={gen}")
    manifest.commit(spark, root, state | {"lists": len(centers)})
    return VectorIndex(root)


def _choose(shared, keep: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries, centers, asked = shared.value
        best: pa.RecordBatch | None = None
        for whole in batches:
            for first in range(0, whole.num_rows, ROW_TILE):
                batch = whole.slice(first, ROW_TILE)
                own, found = batch["list"].to_numpy(), [] if best is None else [best]
                codes = np.frombuffer(b"".join(batch["code"].to_pylist()), np.int8).reshape(batch.num_rows, -1)
                for one in np.unique(own):
                    at, by = np.flatnonzero(own == one), asked.get(int(one))
                    if by is None:
                        continue
                    score = queries[by] @ (centers[one][:, None] + codes[at].T.astype(np.float32) / 127)
                    if len(at) > keep:
                        q, r = np.nonzero(score >= np.partition(score, -keep, axis=1)[:, -keep, None])
                    else:
                        q, r = (v.ravel() for v in np.indices(score.shape))
                    found.append(pa.RecordBatch.from_arrays([pa.array(by[q]), batch["id"].take(pa.array(at[r])), pa.array(score[q, r].astype(np.float64)), pa.array(np.full(len(q), one, np.int32))], ["q", "id", "score", "list"]))
                best = best_of(found, "score", "id", keep) if found else None
        if best is not None:
            yield pa.RecordBatch.from_arrays([ids.take(best["q"]), best["id"], best["score"], best["list"]], ["query_id", "id", "score", "list"])

    return task


def ivf_search(queries: DataFrame, index: VectorIndex, k: int = 3, probes: int = 4, chosen: int = CHOSEN, block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, id, similarity, rank: the k nearest rows of each query among its nearest ``probes`` lists; ties by id.

    Queries are broadcast in blocks of a fixed size with the lists that they probe. Each task passes on its best rows
    of a query by code; of all of them the k * ``chosen`` best are scored exactly."""
    spark = queries.sparkSession
    state = index.state(spark)
    kind = queries.schema["query_id"].dataType.simpleString()
    schema, out = f"query_id {kind}, id {state['id']}, similarity double", None
    rows, keep = index.rows(spark, state), k * chosen
    centers = index.centers(spark, state) if state["lists"] else None
    for part in query_blocks(queries.filter(F.col("embedding").isNotNull()).select("query_id", "embedding"), block) if state["lists"] else ():
        unit = np.nan_to_num(_matrix(pa.array([r.embedding for r in part], pa.list_(pa.float32()))))
        near, _ = _near(unit, centers, min(probes, len(centers)))
        asked = {int(i): np.flatnonzero((near == i).any(axis=1)) for i in np.unique(near)}
        shared = spark.sparkContext.broadcast((pa.array([r.query_id for r in part], ARROW.get(kind)), unit.astype(np.float32), centers.astype(np.float32), asked))
        own = rows.filter(F.col("list").isin(sorted(asked)))
        near_rows = own.select("id", "code", "list").mapInArrow(_choose(shared, keep), f"query_id {kind}, id {state['id']}, score double, list int")
        once = near_rows.groupBy("query_id", "id").agg(F.max("score").alias("score"), F.min("list").alias("list"))  # a row may lie in two lists
        best = once.withColumn("_n", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))).filter(F.col("_n") <= keep)
        asks = spark.createDataFrame([(r.query_id, r.embedding) for r in part], f"query_id {kind}, q array<float>")
        met = own.select("id", "list", "embedding").join(settled(best.select("query_id", "id", "list"))[0], ["id", "list"]).join(F.broadcast(asks), "query_id")  # a block of queries
        one = met.select("query_id", "id", cosine(F.col("q"), F.col("embedding")).alias("similarity")).filter("similarity is not null")
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = spark.createDataFrame([], schema)
    return out.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id"))).filter(F.col("rank") <= k)


def recall(found: DataFrame, queries: DataFrame, kb: DataFrame, k: int) -> DataFrame:
    """One row: queries, wanted (rows of the exact search), found of them, and their share."""
    exact = cosine_topk(queries, kb, k).select("query_id", "id")
    met = exact.join(found.select("query_id", "id", F.lit(1).alias("_found")), ["query_id", "id"], "left")
    return met.agg(F.count_distinct("query_id").alias("queries"), F.count(F.lit(1)).alias("wanted"), F.count("_found").alias("found")).withColumn("recall", F.try_divide("found", "wanted"))
