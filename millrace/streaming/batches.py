"""Sinks built on micro-batches: upsert, fan-out, quarantine, metrics.

Each sink keeps one folder per batch and overwrites it when a batch is
replayed, so a restart neither loses nor doubles rows.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import top_n
from .runner import run_batches, write_batch

REASONS = "reasons"


@contextmanager
def kept(batch: DataFrame):
    """The batch, computed once for several writes."""
    batch.persist()
    try:
        yield batch
    finally:
        batch.unpersist()


def stream_upsert(stream: DataFrame, path: str, keys: list[str], order: list[str], checkpoint: str):
    """Upsert a stream into a table of batches.

    Every batch is reduced to its newest row per key and written on its own, so
    the cost of a batch does not grow with the table.  ``read_updates`` gives
    the current rows."""
    return run_batches(stream, lambda b, i: write_batch(top_n(b, keys, order, 1), i, path), checkpoint)


def stream_fanout(stream: DataFrame, sinks: dict[str, Callable[[DataFrame], DataFrame]], checkpoint: str):
    """Write several results of each batch: ``{path: batch -> DataFrame}``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with kept(batch) as b:
            for path, fn in sinks.items():
                write_batch(fn(b), batch_id, path)

    return run_batches(stream, write, checkpoint)


def stream_once(stream: DataFrame, path: str, checkpoint: str):
    """Rows tagged with their batch; a batch that runs again replaces itself."""
    return run_batches(stream, lambda b, i: write_batch(b, i, path), checkpoint)


def with_reasons(df: DataFrame, rules: dict[str, Column | str]) -> DataFrame:
    """Add the names of the rules a row breaks; each rule describes a bad row."""
    marks = [
        F.when(F.expr(c) if isinstance(c, str) else c, F.lit(name)) for name, c in rules.items()
    ]
    return df.withColumn(REASONS, F.array_compact(F.array(*marks)))


def route(df: DataFrame, rules: dict[str, Column | str]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with their reasons; a row appears once however many rules it breaks."""
    marked = with_reasons(df, rules)
    return marked.where(F.size(REASONS) == 0).drop(REASONS), marked.where(F.size(REASONS) > 0)


def stream_route(
    stream: DataFrame,
    rules: dict[str, Column | str],
    good: str,
    bad: str,
    checkpoint: str,
    metrics: str | None = None,
    upsert: tuple[list[str], list[str]] | None = None,
):
    """Quarantine bad rows of every batch, write the good ones, count both.

    ``upsert`` gives keys and order to reduce the good rows to the newest per
    key.  The counts of a batch come from one scan of it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with kept(with_reasons(batch, rules)) as b:
            ok = b.where(F.size(REASONS) == 0).drop(REASONS)
            write_batch(top_n(ok, *upsert, 1) if upsert else ok, batch_id, good)
            write_batch(b.where(F.size(REASONS) > 0), batch_id, bad)
            if metrics:
                write_batch(batch_metrics(b), batch_id, metrics)

    return run_batches(stream, write, checkpoint)


def batch_metrics(marked: DataFrame) -> DataFrame:
    """One row: rows in, good and quarantined."""
    failed = F.count(F.when(F.size(REASONS) > 0, 1))
    return marked.agg(
        F.count(F.lit(1)).alias("rows_in"),
        (F.count(F.lit(1)) - failed).alias("rows_good"),
        failed.alias("rows_quarantined"),
        F.current_timestamp().alias("processed_at"),
    )


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All batches of a sink, with ``batch_id``."""
    return spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("bigint"))
