"""Batch reads of files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .headers import FILE, without_one

CORRUPT = "_corrupt_record"


def _reader(spark: SparkSession, schema):
    return spark.read.schema(schema) if schema is not None else spark.read


def read_csv(spark: SparkSession, path: str, sep: str = ",", header: bool = True, schema=None) -> DataFrame:
    """CSV files; ``schema`` may be a StructType or DDL text, else types are inferred."""
    reader = _reader(spark, schema).option("sep", sep).option("header", header)
    return (reader if schema is not None else reader.option("inferSchema", True)).csv(path)


def read_json(spark: SparkSession, path: str, schema=None) -> DataFrame:
    return _reader(spark, schema).json(path)


def read_parquet(spark: SparkSession, path: str, evolved: bool = False) -> DataFrame:
    """Parquet files; ``evolved`` merges the schemas of files written over time."""
    return spark.read.option("mergeSchema", evolved).parquet(path)


def read_csv_permissive(
    spark: SparkSession, path: str, schema: StructType | str, header: str | None = None, sep: str = ","
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the text of the lines that do not fit the schema.

    Lines are read as text and parsed by ``from_csv``, so good and bad rows can
    be queried on their own.  ``header`` is the header line to leave out, once
    per file."""
    lines = spark.read.text(path)
    if header is not None:
        lines = without_one(lines.select("value", F.col("_metadata.file_path").alias(FILE)), header)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    marked = StructType(list(schema.fields)).add(CORRUPT, "string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "sep": sep}
    parsed = lines.select(F.from_csv("value", marked.toDDL(), options).alias("r")).select("r.*")
    bad = F.col(CORRUPT).isNotNull()
    return parsed.where(~bad).drop(CORRUPT), parsed.where(bad).select(CORRUPT)


def infer_with_hints(spark: SparkSession, path: str, fmt: str, hints: str, sampling: float = 1.0, **options) -> StructType:
    """Inferred schema with some columns fixed by DDL ``hints``, for batch or stream reads."""
    reader = spark.read.options(**options).option("samplingRatio", sampling)
    if fmt == "csv":
        reader = reader.option("inferSchema", True)
    fixed = {f.name: f for f in StructType.fromDDL(hints).fields}
    inferred = reader.format(fmt).load(path).schema
    fields = [fixed.pop(f.name, f) for f in inferred.fields]
    return StructType(fields + list(fixed.values()))


def with_lineage(df: DataFrame, file_as: str = "source_file_path", time_as: str = "ingest_timestamp") -> DataFrame:
    """Add the file each row came from and the time of the read; for direct file reads."""
    return df.select("*", F.col("_metadata.file_path").alias(file_as), F.current_timestamp().alias(time_as))


def unify(sources: Iterable[tuple[DataFrame, dict[str, tuple[str, str]]]]) -> DataFrame:
    """One table from sources with different names and types.

    Each source comes with ``{target column: (source column, type)}``."""
    out = None
    for df, mapping in sources:
        part = df.select(*[F.col(c).cast(kind).alias(target) for target, (c, kind) in mapping.items()])
        out = part if out is None else out.unionByName(part)
    return out


class MissingSource(RuntimeError):
    """A landing folder or table that a job needs is absent or empty."""


def require_sources(spark: SparkSession, paths: dict[str, str] | None = None, tables: Iterable[str] = ()) -> None:
    """Raise unless every path (``{path: format}``) has rows and every table exists."""
    missing = [t for t in tables if not spark.catalog.tableExists(t)]
    for path, fmt in (paths or {}).items():
        try:
            if spark.read.format(fmt).load(path).limit(1).isEmpty():
                missing.append(path)
        except Exception as e:  # noqa: BLE001 - an unreadable folder is a missing source
            missing.append(f"{path} ({type(e).__name__})")
    if missing:
        raise MissingSource(f"missing or empty: {missing}")
