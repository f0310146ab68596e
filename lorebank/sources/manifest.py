"""Versions of a stored table: a small JSON document a version; the highest one says which files count.

Files are written first and named by the next version's document afterwards, so readers see all of a change or
nothing of it, and a job that dies in between leaves files that nobody names. One writer at a time.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def latest(spark: SparkSession, root: str) -> dict | None:
    """The current version, or None where nothing was committed yet."""
    try:
        rows = spark.read.schema("value string, v int").text(f"{root}/manifest").orderBy(F.desc("v")).limit(1).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return json.loads(rows[0].value) | {"version": rows[0].v} if rows else None


def commit(spark: SparkSession, root: str, content: dict) -> dict:
    """Makes ``content`` the version after the one that it was read from (its ``version``, 0 for none)."""
    version = content.get("version", 0) + 1
    row = spark.createDataFrame([(json.dumps({k: v for k, v in content.items() if k != "version"}),)], "value string")
    row.coalesce(1).write.mode("overwrite").text(f"{root}/manifest/v={version}")  # overwrites what a dead writer began
    return content | {"version": version}
