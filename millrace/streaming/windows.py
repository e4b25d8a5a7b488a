"""Event-time windows and deduplication on streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _flat(df: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *names)


def window_agg(
    stream: DataFrame,
    ts: str,
    length: str,
    aggregates: dict[str, Column],
    keys: list[str] = (),
    slide: str | None = None,
    delay: str | None = None,
) -> DataFrame:
    """Aggregates per tumbling or sliding window and key.

    With ``delay`` the stream has a watermark: in append mode a window is
    emitted once the watermark has passed its end, and its state is dropped."""
    if delay:
        stream = stream.withWatermark(ts, delay)
    window = F.window(ts, length, slide) if slide else F.window(ts, length)
    out = stream.groupBy(window, *keys).agg(*[a.alias(n) for n, a in aggregates.items()])
    return _flat(out, list(keys), list(aggregates))


def session_agg(
    stream: DataFrame,
    ts: str,
    gap: str,
    keys: list[str],
    aggregates: dict[str, Column],
    delay: str | None = None,
) -> DataFrame:
    """Aggregates per session: rows of a key at most ``gap`` apart belong together.

    ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition``
    lets a busy key shuffle few rows; that is for the session's owner to set."""
    if not keys:
        raise ValueError("session windows of a stream need a key")
    if delay:
        stream = stream.withWatermark(ts, delay)
    out = stream.groupBy(F.session_window(ts, gap).alias("window"), *keys).agg(
        *[a.alias(n) for n, a in aggregates.items()]
    )
    return _flat(out, list(keys), list(aggregates))


def open_windows(complete: DataFrame, closed: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Windows of the complete result that the append result has not emitted yet."""
    return complete.join(closed, ["window_start", "window_end", *keys], "left_anti")


def flag_above(df: DataFrame, value: str, limit: float, name: str) -> DataFrame:
    return df.withColumn(name, F.col(value) > limit)


def velocity(stream: DataFrame, key: str, ts: str, limit: int = 5, length: str = "10 minutes", delay: str = "10 minutes") -> DataFrame:
    """Windows with their number of events per key, flagged above ``limit``."""
    out = window_agg(stream, ts, length, {"txn_count": F.count(F.lit(1))}, [key], delay=delay)
    return flag_above(out, "txn_count", limit, "is_velocity_spike")


def amount_rule(
    stream: DataFrame, key: str, ts: str, amount: str, limit: float = 5000,
    length: str = "1 hour", slide: str = "5 minutes", delay: str = "1 hour",
) -> DataFrame:
    """Sliding windows with the amount per key, flagged above ``limit``."""
    total = F.sum(F.col(amount).cast("decimal(18,2)")).cast("double")
    out = window_agg(stream, ts, length, {"total_amount": total}, [key], slide=slide, delay=delay)
    return flag_above(out, "total_amount", limit, "is_amount_threshold_exceeded")


def stream_dedup(stream: DataFrame, keys: list[str], ts: str | None = None, delay: str | None = None) -> DataFrame:
    """First row per key.  Without a watermark the keys seen are kept forever;
    with one, ``ts`` must be among ``keys`` for old state to be dropped."""
    if delay:
        stream = stream.withWatermark(ts, delay)
    return stream.dropDuplicates(keys)


def stream_dedup_within(stream: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """First row per key; a repeat up to ``delay`` later is dropped, whatever its time stamp."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)
