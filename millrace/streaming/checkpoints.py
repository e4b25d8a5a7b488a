"""What streams left behind: progress rows and checkpoint contents."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def progress_row(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Name, batches, input rows and watermark of a query that has run."""
    progress = [json.loads(p.json) if hasattr(p, "json") else p for p in query.recentProgress]
    rows = sum(int(p["numInputRows"]) for p in progress)
    last = progress[-1] if progress else {}
    mark = last.get("eventTime", {}).get("watermark")
    row = (query.name, str(query.id), len(progress), rows, mark)
    return spark.createDataFrame([row], "name string, id string, batches int, input_rows bigint, watermark string")


STATE = "run int, batch_id long, rows_in long, rows_late long, rows_evicted long, rows_in_state long, watermark string"


def state_rows(spark: SparkSession, runs: list[StreamingQuery]) -> DataFrame:
    """Per run and batch: input rows, rows behind the watermark, rows that left the state and rows in it.

    Added over the state operators of a query; an aggregation counts rows
    after it has combined those of one task."""
    out = []
    for i, query in enumerate(runs):
        for p in query.recentProgress:
            p = json.loads(p.json) if hasattr(p, "json") else p
            held = p.get("stateOperators", [])
            total = lambda name: sum(int(s.get(name, 0)) for s in held)  # noqa: E731, B023
            out.append(
                (i, int(p["batchId"]), int(p["numInputRows"]), total("numRowsDroppedByWatermark"), total("numRowsRemoved"), total("numRowsTotal"),
                 p.get("eventTime", {}).get("watermark"))
            )
    return spark.createDataFrame(out, STATE)


def active_queries(spark: SparkSession) -> DataFrame:
    """Queries that run now."""
    rows = [(q.name, str(q.id), q.status.get("message")) for q in spark.streams.active]
    return spark.createDataFrame(rows, "name string, id string, message string")


def checkpoint_summary(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Planned and committed batches of a checkpoint, and whether its query can resume cleanly.

    Batches are planned in ``offsets`` first and marked done in ``commits``
    last; a batch in the first only will be run again."""

    def batches(folder: str) -> DataFrame:
        files = spark.read.format("binaryFile").load(f"{checkpoint}/{folder}").select("path")
        number = F.element_at(F.split("path", "/"), -1).try_cast("bigint")
        return files.select(number.alias("batch")).where("batch is not null")

    def last(folder: str, name: str) -> DataFrame:
        return batches(folder).agg(F.count("batch").alias(f"{name}_batches"), F.max("batch").alias(f"last_{name}"))

    both = last("offsets", "planned").unionByName(last("commits", "committed"), allowMissingColumns=True)
    merged = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return merged.withColumn("clean", F.col("last_planned").eqNullSafe(F.col("last_committed")))
