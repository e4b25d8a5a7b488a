"""Expectations inside a streaming plan.

The rules are part of the plan that writes a batch: one pass counts them,
drops rows and stops at a row that must not be.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import Rule, enforce
from .runner import run_batches, write_batch

METRIC = "rule string, on_fail string, passed long, failed long"
TOTAL = "_total"


def _counts(rules: list[Rule]) -> list[Column]:
    return [F.count(F.lit(1)).alias(TOTAL), *[F.count(F.when(r.passed(), 1)).alias(r.name) for r in rules]]


def _rows(spark: SparkSession, counted: dict, rules: list[Rule]) -> DataFrame:
    total = counted[TOTAL]
    return spark.createDataFrame([(r.name, r.on_fail, counted[r.name], total - counted[r.name]) for r in rules], METRIC)


def expect_stream(stream: DataFrame, rules: list[Rule], name: str = "expectations") -> DataFrame:
    """A stream that counts its rules in every batch, drops rows and fails as they say.

    The counts go to the progress of the query, see :func:`progress_metrics`.
    They are taken before rows are dropped; a NULL condition counts as failed."""
    return enforce(stream.observe(name, *_counts(rules)), rules)


def progress_metrics(query: StreamingQuery, rules: list[Rule], name: str = "expectations") -> DataFrame:
    """Counts per batch and rule from the progress that the query still holds (Spark keeps the last hundred)."""
    spark, out = query.sparkSession if hasattr(query, "sparkSession") else SparkSession.getActiveSession(), []
    for p in query.recentProgress:
        counted = p.observedMetrics.get(name) if hasattr(p, "observedMetrics") else None
        if counted is not None:
            c = counted.asDict()
            out += [(p.batchId, r.name, r.on_fail, c[r.name], c[TOTAL] - c[r.name]) for r in rules]
    return spark.createDataFrame(out, f"batch_id long, {METRIC}")


def run_expected(
    stream: DataFrame,
    rules: list[Rule],
    path: str,
    metrics: str,
    checkpoint: str,
    write: Callable[[DataFrame, int, str], None] = write_batch,
) -> StreamingQuery:
    """Write what the rules let through, and per batch one row of counts for each rule.

    A row that breaks a ``fail`` rule ends the stream within the job that
    writes its batch: nothing of the batch becomes visible, earlier batches
    stay, and after a repair the stream goes on with it.  Counts are written
    after their batch; a batch that is replayed replaces both."""

    def one(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        write(enforce(batch.observe(seen, *_counts(rules)), rules), batch_id, path)
        write_batch(_rows(batch.sparkSession, seen.get, rules), batch_id, metrics)

    return run_batches(stream, one, checkpoint)
