"""Conversations: messages grouped by inactivity, and their texts in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

_MICROS = 1_000_000


def assign_sessions(
    messages: DataFrame, key: str, ts: str, gap_seconds: float, bucket_seconds: int = 3600
) -> DataFrame:
    """Adds ``session_start``: a new session begins after more than the gap.

    Sorting all messages of a key in one task would make a busy key the
    bottleneck. Instead messages are ordered inside (key, time bucket) only.
    One summary row per bucket (first, last and latest start) then tells each
    bucket whether its first message continues an earlier session. A key has at
    most one summary row per bucket of time, however many messages it sends.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    gap = F.lit(int(gap_seconds * _MICROS))
    placed = messages.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).withColumn("__us", micros).withColumn(
        "__bucket", F.floor(F.col("__us") / F.lit(bucket_seconds * _MICROS))
    )
    inside = Window.partitionBy(key, "__bucket").orderBy("__us")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Inside a bucket a start is known, except for the bucket's first message.
    opened = F.when(F.col("__us") - F.lag("__us").over(inside) > gap, F.col("__us"))
    local = placed.withColumn("__opened", opened).withColumn("__start", F.max("__opened").over(so_far))

    summaries = _bucket_summaries(local, key)
    along = Window.partitionBy(key).orderBy("__bucket")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    continues = F.col("__first") - F.lag("__last").over(along) <= gap
    # The start in force when a bucket ends: its own latest, or that of its
    # first message, which is the bucket's first unless it continues.
    opening = F.when(F.coalesce(continues, F.lit(False)), F.lit(None)).otherwise(F.col("__first"))
    carried = (
        summaries.withColumn("__opening", opening)
        .withColumn("__in_force", F.coalesce("__latest", "__opening"))
        .withColumn("__carry", F.coalesce("__opening", F.max("__in_force").over(before)))
        .select(F.col(key).alias("__key"), F.col("__bucket").alias("__b"), "__carry")
    )
    joined = local.join(carried, (F.col(key) == F.col("__key")) & (F.col("__bucket") == F.col("__b")))
    start = F.timestamp_micros(F.coalesce("__start", "__carry"))
    return joined.withColumn("session_start", start).drop(
        "__us", "__bucket", "__opened", "__start", "__key", "__b", "__carry"
    )


def _bucket_summaries(local: DataFrame, key: str) -> DataFrame:
    """First, last and latest known start per key and bucket."""
    return local.groupBy(key, "__bucket").agg(
        F.min("__us").alias("__first"), F.max("__us").alias("__last"), F.max("__opened").alias("__latest")
    )


def unplaced_messages(messages: DataFrame, key: str, ts: str) -> DataFrame:
    """Messages that belong to no session, with the column that is missing as ``reason``."""
    reason = F.when(F.col(key).isNull(), F.lit(key)).when(F.col(ts).isNull(), F.lit(ts))
    return messages.withColumn("reason", reason).where(F.col("reason").isNotNull())


def session_messages(messages: DataFrame, key: str, ts: str, order: str, text: str, gap_seconds: float) -> DataFrame:
    """One row per message: key, session_start, its position from 1, and its text.

    For sessions too long for one row: nothing is collected, and the sort that
    numbers a session can spill.
    """
    started = assign_sessions(messages.select(key, ts, order, text), key, ts, gap_seconds)
    inside = Window.partitionBy(key, "session_start").orderBy(ts, order, text)
    return started.select(key, "session_start", F.row_number().over(inside).alias("position"), text)


def conversation_sessions(
    messages: DataFrame, key: str, ts: str, order: str, text: str, gap_seconds: float
) -> DataFrame:
    """One row per session with its texts joined by newlines, in order.

    A row holds a whole session; ``session_messages`` is the form for endless
    ones. Messages without a key or a time are in ``unplaced_messages``.
    """
    started = assign_sessions(messages.select(key, ts, order, text), key, ts, gap_seconds)
    return started.groupBy(key, "session_start").agg(
        F.count("*").alias("n_messages"),
        F.min(ts).alias("first_message"),
        F.max(ts).alias("last_message"),
        ordered_text([ts, order], text).alias("text"),
    )


def ordered_text(order: list[str], text: str) -> Column:
    """Texts of a group joined by newlines in the given order."""
    pieces = F.sort_array(F.collect_list(F.struct(*order, text)))
    return F.array_join(F.transform(pieces, lambda p: p[text]), "\n")


def conversation_concat(turns: DataFrame) -> DataFrame:
    """One row per conversation with its turns joined in order."""
    return turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"), ordered_text(["turn"], "text").alias("text"))
