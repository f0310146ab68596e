"""Cutting lineage with tables in the folder that every executor sees."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _own_folder() -> str:
    """For sessions without a shared folder, as in tests: one of our own, gone at exit."""
    made = tempfile.mkdtemp(prefix="lorebank-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    return f"file://{made}"


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset: one of our own in local mode, and an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _own_folder()


def checkpointed(df: DataFrame) -> DataFrame:
    """The same rows, written once as Parquet in the shared folder and read back.

    A lost executor then costs a re-read, not a recomputation; the files stay until the folder is cleared.
    """
    path = f"{shared_folder(df.sparkSession)}/lorebank-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, n: int, column: str) -> DataFrame:
    """As ``checkpointed``, for rows that are dealt by a column to n partitions: reading keeps them so, without a shuffle."""
    name = f"lorebank-{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(n, column).option("path", f"{shared_folder(df.sparkSession)}/{name}").saveAsTable(name.replace("-", "_"))
    return df.sparkSession.table(name.replace("-", "_"))


def removed(*tables: DataFrame) -> None:
    """Deletes tables of ``checkpointed`` and ``bucketed`` that no later step reads."""
    for df in tables:
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            if folder.rsplit("/", 1)[1].startswith("lorebank-"):
                path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
                df.sparkSession.sql(f"DROP TABLE IF EXISTS {folder.rsplit('/', 1)[1].replace('-', '_')}")


def shuffles_cleared(spark: SparkSession) -> None:
    """Spark clears the files of a shuffle once the driver has collected its handle as garbage: this asks for it."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
