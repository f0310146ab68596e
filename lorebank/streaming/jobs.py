"""Structured Streaming jobs around messages and files. Each takes a streaming DataFrame; batch twins stand beside."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor

IDLE = "6 hours"


def dedup_messages(messages: DataFrame, key: str = "message_id", ts: str = "ts", watermark: str = IDLE) -> DataFrame:
    """Drops messages that come again within the watermark."""
    return messages.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([key])


def dedup_batch(messages: DataFrame, key: str = "message_id", ts: str = "ts") -> DataFrame:
    """The first of each key."""
    return messages.groupBy(key).agg(F.min_by(F.struct(*messages.columns), ts).alias("m")).select("m.*")


def sessions(messages: DataFrame, user: str = "user_id", ts: str = "ts", idle: str = IDLE, watermark: str | None = None) -> DataFrame:
    """Conversations that end after an idle time: user, start, end (last message and idle time), messages.

    The same for batches and streams; a stream needs a watermark and emits a session once it is closed."""
    rows = messages.withWatermark(ts, watermark) if watermark else messages
    return rows.groupBy(user, F.session_window(ts, idle).alias("w")).agg(F.count(F.lit(1)).alias("messages")).select(user, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "messages")


def retrieve_each(messages: DataFrame, search: Callable[[DataFrame], DataFrame], sink: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """Answers each micro-batch of queries; ``search`` holds the static knowledge base."""
    return messages.writeStream.foreachBatch(lambda batch, n: sink(search(batch), n))


class LastValue(StatefulProcessor):
    """Keeps a user's answers that a request may still ask for, and returns the last one before each ``sources`` request.

    An answer without a value is none. State: the answers since the watermark and the last one before it. With
    ``expires`` (seconds) an answer is forgotten that long after its time, and a timer clears the state of users who
    do not come back."""

    def __init__(self, expires: int | None = None):
        self.expires = expires

    def init(self, handle) -> None:
        self.handle = handle
        self.answers = handle.getListState("answers", "ts timestamp, value string")

    def _held(self) -> list[tuple]:
        return [(pd.Timestamp(ts), value) for ts, value in self.answers.get()] if self.answers.exists() else []

    def _keep(self, answers: list[tuple], watermark_ms: int) -> None:
        now = pd.Timestamp(watermark_ms, unit="ms") if self.expires is not None else None
        if now is not None:
            answers = [a for i, a in enumerate(answers) if (i + 1 == len(answers) or answers[i + 1][0] >= now) and a[0] + pd.Timedelta(seconds=self.expires) >= now]
        else:
            answers = answers[-1:]
        if not answers:
            self.answers.clear()
            return
        self.answers.put([(ts.to_pydatetime(), value) for ts, value in answers])
        if self.expires is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(int(answers[-1][0].timestamp() * 1000) + self.expires * 1000 + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values("ts", kind="stable")
        said = frame[(frame.kind != "sources") & frame.value.notna() & frame.ts.notna()]
        fresh = list(zip(said.ts, said.value))
        held = self._held()
        out = []
        for place, r in enumerate(frame.itertuples()):
            if r.kind != "sources":
                continue
            before = frame.iloc[:place]
            own = before[(before.kind != "sources") & before.value.notna()]
            known = [a for a in held if a[0] <= r.ts] + list(zip(own.ts, own.value))
            last = max(known, key=lambda a: a[0]) if known else None  # of ties the first stands: a held one came earlier
            ties = [a for a in known if last and a[0] == last[0]]
            fits = last is not None and (self.expires is None or r.ts - last[0] <= pd.Timedelta(seconds=self.expires))
            out.append((key[0], r.ts, ties[-1][1] if fits else None))
        self._keep(sorted(held + fresh, key=lambda a: a[0]), timerValues.getCurrentWatermarkInMs() if self.expires is not None else 0)
        yield pd.DataFrame(out, columns=["user_id", "ts", "value"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._keep(self._held(), timerValues.getCurrentWatermarkInMs())
        yield pd.DataFrame([], columns=["user_id", "ts", "value"])

    def close(self) -> None:
        pass


def answer_sources(messages: DataFrame, expires: int | None = None, watermark: str = IDLE) -> DataFrame:
    """messages: user_id, ts, kind (answer or sources), value. Each request with the links of the last answer before it.

    ``expires``: seconds after which an answer is forgotten; rows behind the watermark are then dropped, and state of
    users without a living answer goes. Needs the RocksDB state store."""
    rows = messages if expires is None else messages.withWatermark("ts", watermark)
    return rows.groupBy("user_id").transformWithStateInPandas(LastValue(expires), "user_id bigint, ts timestamp, value string", "Append", "None" if expires is None else "EventTime")


def answer_sources_batch(messages: DataFrame, order: str | None = None, span: str = "day", expires: int | None = None) -> DataFrame:
    """The same over a table: ties in time by ``order``.

    A window sees the messages of one user within one ``span`` only, so that a user with very many is spread over
    tasks; the last answer of each span, one row, is carried into the later ones. Answers without a value count as none."""
    at = ["ts", *([order] if order else [])]
    rows = messages.withColumn("_span", F.date_trunc(span, "ts"))
    answer = (F.col("kind") == "answer") & F.col("value").isNotNull()
    said = F.when(answer, F.struct(F.col("ts").alias("said"), F.col("value").alias("value")))
    last = F.max_by(F.struct(F.col("ts").alias("said"), F.col("value").alias("value")), F.when(answer, F.struct(*at))).alias("_last")
    spans = rows.groupBy("user_id", "_span").agg(last, F.max(F.col("kind") == "sources").alias("_asked"))
    before = Window.partitionBy("user_id").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.withColumn("_carried", F.last("_last", True).over(before)).filter("_asked").select(F.col("user_id").alias("_user"), F.col("_span").alias("_of"), "_carried")
    own = F.last(said, True).over(Window.partitionBy("user_id", "_span").orderBy(*at).rowsBetween(Window.unboundedPreceding, -1))
    found = rows.withColumn("_own", own).filter(F.col("kind") == "sources")
    out = found.join(carried, F.col("user_id").eqNullSafe(F.col("_user")) & F.col("_span").eqNullSafe(F.col("_of")), "left").withColumn("_found", F.coalesce("_own", "_carried"))
    living = F.lit(True) if expires is None else F.unix_micros("ts") - F.unix_micros("_found.said") <= F.lit(expires * 1_000_000)
    return out.withColumn("value", F.when(living, F.col("_found.value"))).select(*messages.columns)


def last_value(rows: DataFrame, user: str, value: str, order) -> DataFrame:
    """The latest value of each user."""
    return rows.groupBy(user).agg(F.max_by(value, order).alias(value))


def ingest_files(files: DataFrame, chunk: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """Chunks new files as they come; ``write`` upserts by id, so a repeated batch changes nothing."""
    return files.writeStream.foreachBatch(lambda batch, n: write(chunk(batch), n))
