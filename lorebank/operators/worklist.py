"""Work lists: what is pending, and how it is dealt to workers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pending(catalog: DataFrame, progress: DataFrame, kind: str, limit: int | None = None, key: str = "episode_id") -> DataFrame:
    """Catalogued sources of a kind that are not done, in order of their key if limited."""
    todo = catalog.filter(F.col(f"has_{kind}")).join(progress.filter(F.col(kind)).select(key), key, "left_anti")
    return todo if limit is None else todo.orderBy(key).limit(limit)


def select_known(ids: DataFrame, catalog: DataFrame, key: str = "episode_id") -> DataFrame:
    return ids.join(catalog.select(key), key, "left_semi")


def round_robin(df: DataFrame, n: int, key: str, parts: int | None = None) -> DataFrame:
    """Adds ``idx`` (place in the order of the key) and ``bucket`` (idx modulo n).

    Places are counted range by range: rows are dealt by range of the key, each range counts its own, and the
    sums of the ranges before (one number a range) are added. No task sees all rows."""
    ranged = (df.repartitionByRange(parts, key) if parts else df.repartitionByRange(key)).withColumn("_range", F.spark_partition_id())
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.min(key).alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_range", before.alias("_start"))  # one row a range
    place = F.row_number().over(Window.partitionBy("_range").orderBy(key)) - 1
    out = ranged.withColumn("_place", place).join(F.broadcast(starts), "_range")
    return out.withColumn("idx", (F.col("_start") + F.col("_place")).cast("long")).withColumn("bucket", F.col("idx") % n).drop("_range", "_place", "_start")


def bucket_load(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("bucket").agg(F.count(F.lit(1)).alias("load"))
