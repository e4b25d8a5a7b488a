"""A sink whose rows stay single whatever is replayed, and that can be folded while it grows.

Below the path of a sink:

``loads/load=N``   the rows of one batch
``notes/load=N``   which checkpoint and batch wrote it, and the source files it holds
``bases/load=N``   newest rows per key of all loads up to N, for upserts
``folded/load=N``  one row once that base is whole

Loads are numbered in the order of their notes, and a note is written after
its rows: what has no note does not exist.  A batch that was noted is not
written again.  A new checkpoint starts its batches from zero and may cut them
elsewhere; rows of files that any note names are left out, so it does no harm.
One stream at a time writes to a sink.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import top_n
from ..sources.storage import exists, remove
from .runner import run_batches

NOTE = "run string, batch_id long, file string, modified timestamp, load long"
FILE, MODIFIED = "_source_file", "_source_modified"


class UnknownOrigin(ValueError):
    """A new checkpoint on a sink with rows, when nothing tells which of them it would repeat."""


def with_origin(stream: DataFrame) -> DataFrame:
    """A stream of files with the file of each row and the time it was written."""
    return stream.withColumns({FILE: F.col("_metadata.file_path"), MODIFIED: F.col("_metadata.file_modification_time")})


def notes(spark: SparkSession, path: str) -> DataFrame:
    """Loads and the source files in them; a load without files has one row."""
    if not exists(spark, f"{path}/notes"):
        return spark.createDataFrame([], NOTE)
    return spark.read.schema(NOTE).parquet(f"{path}/notes")


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The identity of a checkpoint: a lost one that starts anew at its path has another."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def _write(batch: DataFrame, batch_id: int, path: str, checkpoint: str, reduce_batch: Callable[[DataFrame], DataFrame]) -> None:
    spark = batch.sparkSession
    run = run_of(spark, checkpoint)
    known = notes(spark, path)
    mine = (F.col("run") == run) & (F.col("batch_id") == batch_id)
    seen = known.agg(F.max("load").alias("load"), F.max(mine).alias("again"), F.max(F.col("run") == run).alias("run"), F.max(F.col("file").isNotNull()).alias("files")).first()
    if seen.again:
        return
    load = 0 if seen.load is None else seen.load + 1
    tracked = FILE in batch.columns
    if not tracked and seen.load is not None and not seen.run:
        raise UnknownOrigin(f"{path} holds rows of another checkpoint; read files with_origin, or start from an empty sink")
    if tracked:
        # a batch holds few files; only if an older load names one of them is the batch joined
        files = batch.select(FILE, MODIFIED).distinct()
        old = known.select(F.col("file").alias(FILE), F.col("modified").alias(MODIFIED))
        repeated = files.join(old, [FILE, MODIFIED], "left_semi")
        if seen.files and not repeated.isEmpty():
            batch = batch.join(repeated, [FILE, MODIFIED], "left_anti")
            files = files.join(old, [FILE, MODIFIED], "left_anti")
        note = files.select(F.lit(run).alias("run"), F.lit(batch_id).cast("long").alias("batch_id"), F.col(FILE).alias("file"), F.col(MODIFIED).alias("modified"))
        batch = batch.drop(FILE, MODIFIED)
    else:
        note = spark.createDataFrame([(run, batch_id, None, None)], "run string, batch_id long, file string, modified timestamp")
    reduce_batch(batch).write.mode("overwrite").parquet(f"{path}/loads/load={load}")
    note.coalesce(1).write.mode("overwrite").parquet(f"{path}/notes/load={load}")


def stream_to_ledger(stream: DataFrame, path: str, checkpoint: str):
    """Append a stream so that no row is ever there twice.

    With :func:`with_origin` even a lost checkpoint repeats nothing; without,
    a new checkpoint is refused once the sink has rows."""
    return run_batches(stream, lambda b, i: _write(b, i, path, checkpoint, lambda rows: rows), checkpoint)


def upsert_to_ledger(stream: DataFrame, path: str, keys: list[str], order: list[str], checkpoint: str):
    """Upsert a stream: each batch adds its newest row per key, at a cost that does not grow with the table."""
    return run_batches(stream, lambda b, i: _write(b, i, path, checkpoint, lambda rows: top_n(rows, keys, order, 1)), checkpoint)


def _whole(spark: SparkSession, path: str) -> int | None:
    return notes(spark, path).agg(F.max("load")).first()[0]


def _base(spark: SparkSession, path: str) -> int | None:
    if not exists(spark, f"{path}/folded"):
        return None
    return spark.read.schema("rows long, load long").parquet(f"{path}/folded").agg(F.max("load")).first()[0]


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All rows of an appended sink, with ``load``."""
    last = _whole(spark, path)
    return spark.read.parquet(f"{path}/loads").withColumn("load", F.col("load").cast("long")).where(F.col("load") <= F.lit(-1 if last is None else last))


def read_upserts(spark: SparkSession, path: str, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row per key: the last whole base and the loads after it; no other folder is opened."""
    base, last = _base(spark, path), _whole(spark, path)
    rows = spark.read.parquet(f"{path}/loads").withColumn("load", F.col("load").cast("long"))
    later = rows.where(F.col("load").between(-1 if base is None else base + 1, -1 if last is None else last))
    if base is not None:
        folded = spark.read.schema(rows.drop("load").schema).parquet(f"{path}/bases/load={base}")
        later = folded.withColumn("load", F.lit(base).cast("long")).unionByName(later)
    return top_n(later, keys, [*order, "-load"], 1).drop("load")


def compact(spark: SparkSession, path: str, keys: list[str], order: list[str]) -> int | None:
    """Fold all loads into a new base. Readers change to it when it is whole; a fold that breaks off is not seen.

    Loads that arrive meanwhile stay for the next one. Folders that are no
    longer read remain until :func:`vacuum`, for readers under way."""
    last = _whole(spark, path)
    if last is None or last == _base(spark, path):
        return last
    read_upserts(spark, path, keys, order).write.mode("overwrite").parquet(f"{path}/bases/load={last}")
    rows = spark.read.parquet(f"{path}/bases/load={last}").agg(F.count(F.lit(1)).alias("rows"))
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/folded/load={last}")
    return last


def vacuum(spark: SparkSession, path: str) -> None:
    """Remove rows of loads and bases that the last base replaces. Notes stay: they tell what was read."""
    base = _base(spark, path)
    if base is None:
        return
    for (load,) in notes(spark, path).where(F.col("load") <= base).select("load").distinct().collect():
        if load < base:  # the first folder left tells readers the columns
            remove(spark, f"{path}/loads/load={load}")
            remove(spark, f"{path}/folded/load={load}")
            remove(spark, f"{path}/bases/load={load}")
