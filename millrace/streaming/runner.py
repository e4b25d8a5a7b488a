"""Running streams to the end of what is there, with restart-safe sinks."""

from __future__ import annotations

import math
from collections.abc import Callable
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.windows import top_n
from ..sources.storage import empty, make, move, remove

MODES = ("append", "update", "complete")

#: Input that one state partition should serve.
BYTES_PER_STATE = 64 * 1024 * 1024
#: Input, as stored, that one time slice of a replay should hold.
BYTES_PER_SLICE = 128 * 1024 * 1024
_SLICE = "_slice"
#: Lines of text staged by one task for so many slices are written without being sorted first.
OPEN_FILES = 64
#: How they are written: one task reads a compressed file.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 200_000}


def checkpoint_path(root: str, name: str) -> str:
    """One checkpoint per query: two queries must never share one."""
    return f"{root}/checkpoints/{name}"


def stream_table(
    spark: SparkSession, path: str, schema=None, event_time: str | None = None, glob: str | None = None, **options
) -> DataFrame:
    """A parquet table as a stream; ``event_time`` is cast to a zoned timestamp,
    which watermarks need."""
    if schema is None:
        schema = spark.read.parquet(path if glob is None else f"{path}/{glob}").schema
    reader = spark.readStream.schema(schema).options(**options)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    stream = reader.parquet(path)
    return stream.withColumn(event_time, F.col(event_time).cast("timestamp")) if event_time else stream


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Length of all files at some paths."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return files.agg(F.sum("length")).first()[0] or 0


def time_slices(stored: int, bytes_per_slice: int = BYTES_PER_SLICE) -> int:
    """Number of slices for so many stored bytes."""
    return max(1, math.ceil(stored / bytes_per_slice))


def state_partitions(spark: SparkSession, path: str) -> int:
    """Number of state partitions for a stream over the files at ``path``.

    A new query fixes this number in its checkpoint, and adaptive execution
    does not correct it, so it should follow the data: each partition costs a
    state store per batch.  It stays within what the session is set up for."""
    size = stored_bytes(spark, path)
    cores = spark.sparkContext.defaultParallelism
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * cores)
    wanted = math.ceil(size / BYTES_PER_STATE)
    # whole rounds of tasks: a last round of a few would leave most cores idle, in every batch
    return min(math.ceil(wanted / cores) * cores if wanted > 8 else 8, most)


@contextmanager
def _settings(spark: SparkSession, own: dict[str, str]):
    before = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def sized_state(spark: SparkSession, partitions: int):
    """Streams started inside keep their state in that many partitions."""
    return _settings(spark, {"spark.sql.shuffle.partitions": str(partitions)})


def little_left(spark: SparkSession):
    """Queries inside remove their shuffle files when they end; streams started inside can resume from their last
    batches only, and drop the state of earlier ones."""
    # changes of the state can go when a snapshot holds them
    state = {"spark.sql.streaming.minBatchesToRetain": "2", "spark.sql.streaming.stateStore.minDeltasForSnapshot": "2"}
    return _settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", **state})


def check_mode(mode: str, aggregated: bool, watermarked: bool) -> None:
    """Reject a mode the plan cannot have, before anything starts."""
    if mode not in MODES:
        raise ValueError(f"unknown output mode {mode!r}")
    if mode == "complete" and not aggregated:
        raise ValueError("complete mode rewrites a whole result: it needs an aggregation")
    if mode == "append" and aggregated and not watermarked:
        raise ValueError("append mode can only emit closed groups: an aggregation needs a watermark")


def _finish(writer, name: str | None, checkpoint: str) -> StreamingQuery:
    if name:
        writer = writer.queryName(name)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_append(
    df: DataFrame, path: str, checkpoint: str, name: str | None = None, partition_by: list[str] = ()
) -> StreamingQuery:
    """Append to a parquet table; its commit log makes a replayed batch count once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path)
    return _finish(writer.partitionBy(*partition_by) if partition_by else writer, name, checkpoint)


def _edges(times: list[DataFrame], slices: int) -> list[int]:
    """Microseconds at which a new slice begins; each is at or before the last time of every table.

    So the last slice has the newest row of each stream, and with them the final watermark."""
    ends = [t.agg(F.max("_t")).first()[0] for t in times]
    if slices < 2 or None in ends:
        return []
    at = reduce(DataFrame.unionByName, times).approxQuantile("_t", [i / slices for i in range(1, slices)], 0.1 / slices)
    return sorted({min(int(e), *ends) for e in at})


def replay_append(
    tables: list[tuple[DataFrame, str]], build: Callable[..., DataFrame], root: str, slices: int, form: str = "parquet"
) -> tuple[DataFrame, StreamingQuery]:
    """Stream ``tables``, each with its time column, in the order of time, and append the result.

    Returns what the sink holds, and the query.
    ``build`` makes the result from one stream per table.  The rows are staged
    by time slice, and a slice is handed to the running query, as one folder, when
    the slice before it is done.  Rows come in order, so none is late, and the
    state holds one slice and what the watermark keeps, not whole tables.
    Rows without a time come first.  ``form="text"`` streams the column
    ``value`` as lines, which are staged compressed.  A slice that is done is
    removed, and so is what the joins of ``tables`` shuffled: only the result stays.
    """
    spark = tables[0][0].sparkSession
    with little_left(spark):
        return _replayed(spark, tables, build, root, slices, form)


def _replayed(spark, tables, build, root, slices, form):
    micros = [F.unix_micros(F.col(time).cast("timestamp")) for _, time in tables]
    edges = _edges([df.select(m.alias("_t")) for (df, _), m in zip(tables, micros)], slices)
    streams = []
    for i, ((df, _), at) in enumerate(zip(tables, micros)):
        number = F.coalesce(reduce(lambda a, b: a + b, [(at >= e).cast("int") for e in edges], F.lit(0)), F.lit(0))
        rows = df.select("value") if form == "text" else df
        writer = df.select(*rows.columns, number.alias(_SLICE)).write.partitionBy(_SLICE).format(form)
        if form == "text":
            with _settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}):
                writer.options(**PACKED).save(f"{root}/staged-{i}")
        else:
            writer.save(f"{root}/staged-{i}")
        make(spark, f"{root}/in-{i}")
        reader = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True)
        streams.append(reader.format(form).load(f"{root}/in-{i}"))
    out = build(*streams)
    writer = out.writeStream.format("parquet").outputMode("append").option("path", f"{root}/table")
    query = writer.option("checkpointLocation", f"{root}/checkpoint").start()
    try:
        for n in range(len(edges) + 1):
            for i in range(len(tables)):
                move(spark, f"{root}/staged-{i}/{_SLICE}={n}", f"{root}/in-{i}/{_SLICE}={n}")
            query.processAllAvailable()
            for i in range(len(tables)):
                empty(spark, f"{root}/in-{i}/{_SLICE}={n}")
    finally:
        query.stop()
    for i in range(len(tables)):
        remove(spark, f"{root}/in-{i}")
        remove(spark, f"{root}/staged-{i}")
    return spark.read.schema(out.schema).parquet(f"{root}/table"), query


def run_batches(
    df: DataFrame,
    fn: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    name: str | None = None,
) -> StreamingQuery:
    """Hand every micro-batch to ``fn(batch, batch_id)``."""
    return _finish(df.writeStream.outputMode(mode).foreachBatch(fn), name, checkpoint)


def write_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """Write a batch into its own folder; a replay overwrites it, nothing is doubled."""
    batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def run_complete(df: DataFrame, path: str, checkpoint: str, name: str | None = None) -> StreamingQuery:
    """Replace the result table after every batch (file sinks refuse this mode)."""

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return run_batches(df, replace, checkpoint, "complete", name)


def run_update(df: DataFrame, path: str, checkpoint: str, name: str | None = None) -> StreamingQuery:
    """Write the changed groups of every batch; read them with ``read_updates``."""
    return run_batches(df, lambda b, i: write_batch(b, i, path), checkpoint, "update", name)


def read_updates(spark: SparkSession, path: str, keys: list[str], order: list[str] = ()) -> DataFrame:
    """The newest row per key over all batches, by ``order`` and then by batch."""
    rows = spark.read.option("recursiveFileLookup", False).parquet(path)
    return top_n(rows, keys, [*order, "-batch_id"], 1).drop("batch_id")
