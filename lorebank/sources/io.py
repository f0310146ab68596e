"""Reading and writing: markdown trees, CSV rows, keyed JSON, chunk collections, documents, evaluation runs, embeddings."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KB_CSV = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "topic", "text", "active")])
QUESTION = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("type", T.StringType()), T.StructField("question", T.StringType()),
    T.StructField("expected_episodes", T.ArrayType(T.IntegerType())), T.StructField("expected_keywords", T.ArrayType(T.StringType())), T.StructField("notes", T.StringType()),
])
#: Questions of a run that is stored as one document.
MAX_QUESTIONS = 100_000
RESULT = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("type", T.StringType()), T.StructField("question", T.StringType()), T.StructField("hit", T.BooleanType()),
    T.StructField("rank", T.IntegerType()), T.StructField("topScore", T.DoubleType()), T.StructField("gotEpisodes", T.ArrayType(T.IntegerType())),
])
RUN = T.StructType([
    T.StructField("timestamp", T.StringType()), T.StructField("mode", T.StringType()), T.StructField("topK", T.IntegerType()), T.StructField("totalQuestions", T.IntegerType()),
    T.StructField("evaluable", T.IntegerType()), T.StructField("hits", T.IntegerType()), T.StructField("recallAtK", T.DoubleType()), T.StructField("mrr", T.DoubleType()),
    T.StructField("avgOfftopicScore", T.DoubleType()), T.StructField("results", T.ArrayType(RESULT)),
])


def read_markdown(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """episode_id, kind, text of ``root/EP-<digits>/<kind>.md``; a missing file has no row."""
    path = F.col("_metadata.file_path")
    rows = spark.read.text(f"{root}/*/{kind}.md", wholetext=True).select(F.regexp_extract(path, r"/(EP-\d+)/[^/]+$", 1).alias("episode_id"), F.lit(kind).alias("kind"), F.col("value").alias("text"))
    return rows.filter("episode_id <> ''")


def stream_markdown(spark: SparkSession, root: str, archive: str | None = None, files_a_batch: int = 1000) -> DataFrame:
    """A stream of episode_id, text of new files below ``root`` with ``EP-<digits>`` in a folder's name.

    ``archive``: a folder outside ``root`` to which files are moved after the batch that read them is done."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_a_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    rows = reader.text(root, wholetext=True, recursiveFileLookup=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"/(?:[^/]*=)?(EP-\d+)/[^/]+$", 1).alias("episode_id"), F.col("value").alias("text"))
    return rows.filter("episode_id <> ''")


def read_kb_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(KB_CSV).csv(path, header=True, quote='"', escape='"')


def csv_cell(name: str):
    """Null is empty, newlines are spaces, trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(F.col(name).cast("string"), F.lit("")), r"\r?\n", " ")).alias(name)


def write_kb_csv(df: DataFrame, path: str) -> None:
    df.select(*[csv_cell(c) for c in df.columns]).write.csv(path, header=True, quote='"', escape='"', emptyValue="")


def read_keyed_json(spark: SparkSession, path: str, value_schema: str) -> DataFrame:
    """key, value of JSON objects whose members are rows."""
    rows = spark.read.text(path, wholetext=True).select(F.from_json("value", f"map<string,{value_schema}>").alias("m"))
    return rows.select(F.explode("m"))


def read_chunks(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A JSON array of objects a file, or an object a line: the first character of the first file tells which."""
    start = spark.read.text(path).filter(F.trim("value") != "").first()
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path, multiLine=start is not None and start.value.lstrip().startswith("["))


def write_chunks(df: DataFrame, path: str) -> None:
    df.write.json(path)


def write_episode_docs(docs: DataFrame, path: str) -> None:
    """JSON documents, a folder for each hundredth of the ids, and beside them a compact index."""
    from lorebank.operators.catalog import compact_index

    docs.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(100))).write.partitionBy("part").json(f"{path}/episodes")
    compact_index(docs).write.json(f"{path}/index")


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    """query_id, type, question, expected (episodes), keywords."""
    schema = T.StructType([T.StructField("description", T.StringType()), T.StructField("generatedAt", T.StringType()), T.StructField("questions", T.ArrayType(QUESTION))])
    q = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("questions").alias("q"))
    none = F.array().cast("array<int>")
    return q.select(F.col("q.id").alias("query_id"), "q.type", "q.question", F.coalesce("q.expected_episodes", none).alias("expected"), F.col("q.expected_keywords").alias("keywords"))


def write_eval_run(spark: SparkSession, judged: DataFrame, retrieved: DataFrame, folder: str, mode: str, top_k: int, stamp: int) -> str:
    """One file a run, with its mode and time in the name of its folder. A run is one JSON document: at most ``MAX_QUESTIONS``."""
    from lorebank.operators.evaluate import eval_summary

    if judged.limit(MAX_QUESTIONS + 1).count() > MAX_QUESTIONS:
        raise ValueError(f"a stored run has at most {MAX_QUESTIONS} questions: write its tables as Parquet instead")
    got = retrieved.groupBy("query_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "episode"))), lambda r: r["episode"]).alias("gotEpisodes"))
    each = judged.join(got, "query_id", "left").select(F.struct(F.col("query_id").alias("id"), "type", *([F.col("question")] if "question" in judged.columns else [F.lit(None).cast("string").alias("question")]), "hit", "rank", F.col("top_score").alias("topScore"), "gotEpisodes").alias("r"))
    whole = each.agg(F.sort_array(F.collect_list("r")).alias("results")).crossJoin(eval_summary(judged))  # two single rows
    run = whole.select(
        F.lit(str(stamp)).alias("timestamp"), F.lit(mode).alias("mode"), F.lit(top_k).alias("topK"), F.size("results").alias("totalQuestions"), "evaluable", "hits",
        F.col("recall").alias("recallAtK"), "mrr", F.col("offtopic_score").alias("avgOfftopicScore"), "results",
    )
    path = f"{folder}/eval_{mode}_{stamp}"
    run.coalesce(1).write.json(path)
    return path


def read_eval_runs(spark: SparkSession, path: str) -> DataFrame:
    """One row a question of each stored run: run (file name), mode, and the question's columns."""
    rows = spark.read.schema(RUN).json(path, multiLine=True, recursiveFileLookup=True).select(F.col("_metadata.file_name").alias("run"), "mode", F.explode("results").alias("r"))
    return rows.select("run", "mode", F.col("r.id").alias("query_id"), F.col("r.type").alias("type"), F.col("r.question").alias("question"), F.col("r.hit").alias("hit"), F.col("r.rank").alias("rank"), F.col("r.topScore").alias("top_score"), F.col("r.gotEpisodes").alias("got"))


def retried(call: Callable, tries: int = 4, first_wait: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> Callable:
    """A call that is repeated after 1, 2, 4, … seconds; the last failure is raised."""

    def again(*args):
        for i in range(tries + 1):
            try:
                return call(*args)
            except Exception:
                if i == tries:
                    raise
                sleep(first_wait * 2**i)

    return again


def mapped_batches(df: DataFrame, call: Callable[[pd.DataFrame], pd.Series], name: str, kind: T.DataType, batch: int = 100, tries: int = 4, wait: float = 1.0) -> DataFrame:
    """Adds a column by a user's call on pandas batches of at most so many rows: order kept, failures retried.

    For embedders, translators, query rewriters and other outside services. Checkpoint before it."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = retried(call, tries, wait)
        for frame in frames:
            for i in range(0, len(frame), batch):
                part = frame.iloc[i : i + batch]
                yield part.assign(**{name: list(ask(part))})

    return df.mapInPandas(run, T.StructType([*df.schema.fields, T.StructField(name, kind)]))


def embed(df: DataFrame, text_col: str, embedder: Callable[[list[str]], list[list[float]]], batch: int = 100, tries: int = 4, wait: float = 1.0) -> DataFrame:
    """Adds ``embedding`` by a user's embedder of lists of texts."""
    return mapped_batches(df, lambda part: embedder(part[text_col].tolist()), "embedding", T.ArrayType(T.FloatType(), False), batch, tries, wait)
