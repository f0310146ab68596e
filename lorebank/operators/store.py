"""The knowledge base as a stored table: upserts rewrite touched buckets only, readers see whole versions, tenants are read apart.

Files lie in ``data/gen=<version>/bucket=<hash of the id>/tenant_id=<tenant>``: a bucket holds the rows of some ids,
so an upsert reads and rewrites the buckets of its ids, and only those in which a row really changes; a tenant is
a folder of each bucket, so even one with most rows is spread, and a search within tenants reads no other's files.
The manifest names the generation of each bucket, and the last batch that each stream has written, in one step:
a batch that comes again is skipped. Generations that no manifest names any more may be deleted.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from lorebank.operators.kb import latest_by_key, maybe_broadcast, upsert, visible
from lorebank.sources import manifest

BUCKETS = 64


@dataclass(frozen=True)
class KbStore:
    root: str

    def state(self, spark: SparkSession) -> dict:
        found = manifest.latest(spark, self.root)
        if found is None:
            raise ValueError(f"no table in {self.root}")
        return found


def bucket_of(key: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string") if isinstance(key, str) else key), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, root: str, gen: int, state: dict) -> list[int]:
    """Writes a generation of some buckets; which ones."""
    path, key, tenant = f"{root}/data/gen={gen}", state["key"], state["tenant"]
    own = rows.withColumn("bucket", bucket_of(key, state["buckets"]))
    own.repartition("bucket").sortWithinPartitions("bucket", tenant, key).write.mode("overwrite").partitionBy("bucket", tenant).parquet(path)
    schema = T.StructType.fromJson(state["schema"]).add("bucket", T.IntegerType())
    return [r.bucket for r in rows.sparkSession.read.schema(schema).parquet(path).select("bucket").distinct().collect()]


def create_store(rows: DataFrame, root: str, key: str = "id", tenant: str = "tenant_id", buckets: int = BUCKETS) -> KbStore:
    """Writes rows with distinct keys as the first version, or as a new one with nothing of the old."""
    spark = rows.sparkSession
    before = manifest.latest(spark, root) or {}
    state = {"version": before.get("version", 0), "key": key, "tenant": tenant, "buckets": buckets, "schema": rows.schema.jsonValue(), "ledger": {}}
    gen = state["version"] + 1
    state["parts"] = {str(b): gen for b in _write(rows, root, gen, state)}
    manifest.commit(spark, root, state)
    return KbStore(root)


def read_store(spark: SparkSession, store: KbStore, state: dict | None = None, buckets: list[int] | None = None) -> DataFrame:
    """The rows of the current version (or of ``state``), of all buckets or of some. A filter on the tenant prunes folders."""
    state = state or store.state(spark)
    schema = T.StructType.fromJson(state["schema"])
    parts = {b: g for b, g in state["parts"].items() if buckets is None or int(b) in buckets}
    if not parts:
        return spark.createDataFrame([], schema)
    inner = T.StructType([*schema.fields, T.StructField("gen", T.IntegerType()), T.StructField("bucket", T.IntegerType())])
    paths = [f"{store.root}/data/gen={g}/bucket={b}" for b, g in sorted(parts.items())]
    return spark.read.schema(inner).option("basePath", f"{store.root}/data").parquet(*paths).select(*schema.names)


def upsert_store(store: KbStore, updates: DataFrame, order: str | None = None, batch: tuple[str, int] | None = None) -> list[int]:
    """Rows of ``updates`` win, column by column, as ``kb.upsert``; the buckets that were rewritten.

    Of equal keys the last by ``order`` counts. Buckets in which no row changes stay as they are, so the same
    updates again rewrite none. ``batch``: name of a stream and number of its batch; one not above the last that was
    written is skipped."""
    spark = updates.sparkSession
    state = store.state(spark)
    key, names = state["key"], [f["name"] for f in state["schema"]["fields"]]
    if batch and state["ledger"].get(batch[0], -1) >= batch[1]:
        return []
    one = latest_by_key(updates, key, order) if order else updates.dropDuplicates([key])
    own = [c for c in one.columns if c in names]
    work = f"{store.root}/work/version={state['version'] + 1}"
    one.select(*own).withColumn("_bucket", bucket_of(key, state["buckets"])).write.mode("overwrite").parquet(work)
    fresh = spark.read.schema(one.select(*own).schema.add("_bucket", T.IntegerType())).parquet(work)
    touched = [r._bucket for r in fresh.select("_bucket").distinct().collect()]
    there = read_store(spark, store, state, touched)
    payload = [c for c in own if c != key]
    old = there.select(F.col(key), F.lit(True).alias("_there"), F.struct(*[F.col(c).alias(c) for c in payload] or [F.lit(1).alias("_")]).alias("_old"))
    kinds = {f.name: f.dataType for f in there.schema.fields}
    new = F.struct(*[F.col(c).cast(kinds[c]).alias(c) for c in payload] or [F.lit(1).alias("_")])
    changed = fresh.join(old, key, "left").filter(F.col("_there").isNull() | ~new.eqNullSafe(F.col("_old")))
    rewritten = sorted(r._bucket for r in changed.select("_bucket").distinct().collect())
    if rewritten:
        merged = upsert(read_store(spark, store, state, rewritten), fresh.filter(F.col("_bucket").isin(rewritten)).drop("_bucket"), key)
        cast = merged.select(*[F.col(c).cast(kinds[c]).alias(c) for c in names])
        gen = state["version"] + 1
        state = state | {"parts": state["parts"] | {str(b): gen for b in _write(cast, store.root, gen, state)}}
    if batch:
        state = state | {"ledger": state["ledger"] | {batch[0]: batch[1]}}
    if rewritten or batch:
        manifest.commit(spark, store.root, state)
    return rewritten


def visible_in_store(spark: SparkSession, store: KbStore, tenant: str | None = None, brand: str | None = None, need_vector: bool = False) -> DataFrame:
    """``kb.visible`` of the stored rows: of a tenant only its folders are read."""
    return visible(read_store(spark, store), tenant, brand, need_vector)


def rows_of_tenants(store: KbStore, requests: DataFrame) -> DataFrame:
    """Active rows of the tenants that ask (requests: the tenant's column): folders of all others are pruned when it runs."""
    spark = requests.sparkSession
    tenant = store.state(spark)["tenant"]
    # Any text is at least the empty one; only below a comparison does Spark prune partitions at run time.
    asking = requests.select(tenant).filter(F.col(tenant) >= "").distinct()
    return visible(read_store(spark, store)).join(maybe_broadcast(asking), tenant, "left_semi")


def ingest_to_store(files: DataFrame, chunk: Callable[[DataFrame], DataFrame], store: KbStore, name: str, order: str | None = None) -> DataStreamWriter:
    """Chunks new files as they come into the stored table, each batch once: its number is committed with its rows.

    A query restarted from its checkpoint repeats the batch that it was in; where that was written, it is skipped."""
    return files.writeStream.queryName(name).foreachBatch(lambda batch, n: upsert_store(store, chunk(batch), order, (name, n)) and None)
