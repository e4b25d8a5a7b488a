"""Incremental ingestion: every file once."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..streaming.runner import run_append
from .rescue import rescue_json


class SchemaChanged(ValueError):
    """New files hold columns the schema does not know."""


def merged(known: StructType, found: StructType) -> StructType:
    """``known`` followed by the columns only ``found`` has."""
    have = {f.name for f in known.fields}
    return StructType(list(known.fields) + [f for f in found.fields if f.name not in have])


def ingest_files(
    spark: SparkSession,
    src: str,
    fmt: str,
    schema: StructType | str,
    checkpoint: str,
    sink: str,
    evolution: str = "ignore",
    since: str | None = None,
    **options,
) -> StructType:
    """Append the files that arrived since the last run with this checkpoint.

    ``evolution`` says what happens to columns missing from ``schema``:
    ``ignore`` drops them, ``add`` widens the schema (earlier rows read NULL),
    ``fail`` raises before anything is written, ``rescue`` (JSON only) keeps
    them in ``_rescued_data``.  Looking for new columns reads the files once
    more; ``since`` (a time of the last run) limits that to files modified
    after it.  Returns the schema in use, to pass next time."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if evolution == "rescue":
        lines = spark.readStream.options(**options).text(src)
        run_append(rescue_json(lines, schema), sink, checkpoint)
        return schema
    if evolution in ("add", "fail"):
        reader = spark.read.options(**options)
        if fmt == "csv":
            reader = reader.option("inferSchema", True)
        if since:
            reader = reader.option("modifiedAfter", since)
        wide = merged(schema, reader.format(fmt).load(src).schema)
        if evolution == "fail" and len(wide) > len(schema):
            raise SchemaChanged(f"new columns: {[f.name for f in wide.fields[len(schema):]]}")
        schema = wide
    stream = spark.readStream.schema(schema).options(**options).format(fmt).load(src)
    run_append(stream, sink, checkpoint)
    return schema


MANIFEST = "path string, load_id string"


def _manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """Files per load; the entry without a path says that the load is complete."""
    try:
        return spark.read.schema(MANIFEST).parquet(manifest)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":  # no manifest before the first load
            return spark.createDataFrame([], MANIFEST)
        raise


def new_files(spark: SparkSession, src: str, manifest: str) -> DataFrame:
    """Files below ``src`` that the manifest does not list; their content is not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(src).select("path")
    return found.join(_manifest(spark, manifest), "path", "left_anti")


def load_once(
    spark: SparkSession, src: str, fmt: str, target: str, manifest: str, schema: StructType | str, **options
) -> int:
    """Load the files not loaded before; returns how many.

    The manifest names the files of a load before its rows are written, and
    its end after.  A load without an end is written again, with its own files
    and over its own folder, before newer files make up the next load.  Only
    file names reach the driver, as for any read that lists files."""
    entries = _manifest(spark, manifest)
    ended = entries.where("path is null").select("load_id")
    broken: dict[str, list[str]] = {}
    for row in entries.where("path is not null").join(ended, "load_id", "left_anti").distinct().collect():
        broken.setdefault(row.load_id, []).append(row.path)
    fresh = sorted(r.path for r in new_files(spark, src, manifest).collect())
    if fresh:
        load_id = hashlib.sha256("\n".join(fresh).encode()).hexdigest()[:16]
        _note(spark, manifest, [(p, load_id) for p in fresh])
        broken[load_id] = fresh
    for load_id, paths in broken.items():
        rows = spark.read.schema(schema).options(**options).format(fmt).load(paths)
        rows.write.mode("overwrite").parquet(f"{target}/load_id={load_id}")
        _note(spark, manifest, [(None, load_id)])
    return sum(map(len, broken.values()))


def _note(spark: SparkSession, manifest: str, entries: list[tuple[str | None, str]]) -> None:
    spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("append").parquet(manifest)


def read_loaded(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).drop("load_id")
