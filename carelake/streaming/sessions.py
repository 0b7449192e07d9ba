"""Conversations on a stream of messages."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from carelake.operators.sessions import ordered_text


def conversation_sessions_stream(
    messages: DataFrame, key: str, ts: str, order: str, text: str, gap: str = "15 seconds",
    lateness: str = "1 minute",
) -> DataFrame:
    """Sessions that close once the watermark passes their end (append mode).

    Event time must be a timestamp with the session zone; a zone-free column is
    cast. Rows later than the watermark are dropped by the engine, and sessions
    still open at the last watermark are not emitted.
    """
    timed = messages.where(F.col(key).isNotNull()).withColumn(ts, F.col(ts).cast("timestamp"))
    return (
        timed.withWatermark(ts, lateness)
        .groupBy(F.col(key), F.session_window(ts, gap).alias("session"))
        .agg(F.count("*").alias("n_messages"), ordered_text([ts, order], text).alias("text"))
        .select(
            key,
            F.col("session.start").alias("session_start"),
            F.col("session.end").alias("session_end"),
            "n_messages",
            "text",
        )
    )


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Start an append query that processes what is available, then stops."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocks_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, as message streams must."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)


class _Placing(StatefulProcessor):
    """Messages of one key in time order, each with its session, as the watermark passes them.

    State is what the watermark has not passed yet, at most the messages of the
    lateness, and three numbers of the open session, however long it gets; both
    go when the session is over.
    """

    def __init__(self, key: str, gap_us: int):
        self.key, self.gap_us = key, gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "us bigint, ord string, text string")
        self.open = handle.getValueState("open", "start bigint, last bigint, position bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        fresh = []
        for us, order, text in ((r.us, r.ord, r.text) for r in rows):
            if us <= passed:
                yield self._row(key, us, order, text, None, None, "late")
            else:
                fresh.append((us, order, text))
        if fresh:
            self.waiting.appendList(fresh)
            self._wake(min(us for us, _, _ in fresh))
        # Nothing that waited can have passed before there is a watermark.
        if passed > 0:
            yield from self._place(key, passed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._place(key, timerValues.getCurrentWatermarkInMs() * 1000)

    def _place(self, key, passed: int) -> Iterator[Row]:
        messages = sorted((tuple(m) for m in self.waiting.get()), key=lambda m: (m[0], *((part is not None, part or "") for part in m[1:])))
        due = bisect_right(messages, passed, key=lambda m: m[0])
        start, last, position = self.open.get() or (None, None, 0)
        for us, order, text in messages[:due]:
            if last is None or us - last > self.gap_us:
                start, position = us, 0
            last, position = us, position + 1
            yield self._row(key, us, order, text, start, position, None)
        if due:
            if due < len(messages):
                self.waiting.put(messages[due:])
            else:
                self.waiting.clear()
        if last is not None and last + self.gap_us < passed:
            self.open.clear()
            last = None
        elif due:
            self.open.update((start, last, position))
        # The next message to pass, or else the end of the open session; a timer that comes too early changes nothing.
        if due < len(messages):
            self._wake(messages[due][0])
        elif last is not None:
            self._wake(last + self.gap_us + 1)

    def _wake(self, us: int) -> None:
        self.handle.registerTimer(us // 1000 + 1)

    def _row(self, key, us, order, text, session, position, reason) -> Row:
        return Row(**{self.key: key[0]}, us=us, ord=order, text=text, session=session, position=position, reason=reason)

    def close(self) -> None:
        pass


def session_messages_stream(
    messages: DataFrame, key: str, ts: str, order: str, text: str, gap_seconds: float = 15, lateness: str = "1 minute",
) -> DataFrame:
    """One row per message with its session and its position there, or with the reason why it has none.

    The streaming form of ``session_messages`` for sessions of any length: rows
    go out when the watermark has passed them, one by one and in order, and
    nothing grows with a session. A message that comes after the watermark has
    the reason ``late``, one without key or time that column's name; their
    session_start and position are null. What the watermark has not passed when
    the stream stops waits in the state for the next run. ``key`` and ``order``
    come out as text. Start it inside ``rocks_state``.
    """
    named = messages.select(F.col(key).cast("string").alias(key), F.col(ts).cast("timestamp").alias(ts), F.col(order).cast("string").alias("ord"), text)
    known = named.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).withWatermark(ts, lateness)
    # The engine drops late rows where it sees the time column; here they come out with a reason.
    timed = known.select(key, F.unix_micros(ts).alias("us"), "ord", F.col(text).alias("text"))
    placed = timed.groupBy(key).transformWithState(
        statefulProcessor=_Placing(key, int(gap_seconds * 1_000_000)),
        outputStructType=f"`{key}` string, us bigint, ord string, text string, session bigint, position bigint, reason string",
        outputMode="Append", timeMode="EventTime")
    reason = F.when(F.col(key).isNull(), F.lit(key)).when(F.col(ts).isNull(), F.lit(ts))
    unplaced = named.withColumn("reason", reason).where(F.col("reason").isNotNull()).select(
        key, F.unix_micros(ts).alias("us"), "ord", F.col(text).alias("text"), F.lit(None).cast("long").alias("session"),
        F.lit(None).cast("long").alias("position"), "reason")
    return placed.unionByName(unplaced).select(
        key, F.timestamp_micros("us").alias(ts), F.col("ord").alias(order), F.col("text").alias(text),
        F.timestamp_micros("session").alias("session_start"), "position", "reason")
