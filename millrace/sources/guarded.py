"""Tables whose constraints are stored beside them and hold for every write.

The constraints of the table at ``path`` are rows in the folder
``path.constraints``, which no write to the table touches.  A write carries
them as an assertion in its own plan: the rows are checked as they are
written, in one scan, and a row that violates one fails the job before
anything of the write is committed.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import UPSERT
from ..operators.quality import Constraint, asserted, require
from ..session import pin
from . import sinks
from .storage import exists

STORED = "name string, expression string, null_passes boolean, added long, dropped boolean, version long"


def _folder(path: str) -> str:
    return f"{path.rstrip('/')}.constraints"


def constraints(spark: SparkSession, path: str) -> list[Constraint]:
    """The constraints that hold for a table, by name: of each name the last row, unless that drops it."""
    if not exists(spark, _folder(path)):
        return []
    rows = spark.read.schema(STORED).parquet(_folder(path))
    last = rows.groupBy("name").agg(F.max_by(F.struct("expression", "null_passes", "dropped"), "version").alias("c"))
    found = last.where("not c.dropped").select("name", "c.expression", "c.null_passes").orderBy("name").collect()
    return [Constraint(*r) for r in found]


def _note(spark: SparkSession, path: str, constraint: Constraint, dropped: bool) -> None:
    known = exists(spark, _folder(path))
    last = spark.read.schema(STORED).parquet(_folder(path)).agg(F.max("version")).first()[0] if known else None
    version = 0 if last is None else last + 1
    row = (constraint.name, constraint.expression, constraint.null_passes, int(time.time()), dropped)
    df = spark.createDataFrame([row], "name string, expression string, null_passes boolean, added long, dropped boolean")
    df.coalesce(1).write.mode("overwrite").parquet(f"{_folder(path)}/version={version}")


def add_constraint(spark: SparkSession, path: str, constraint: Constraint) -> None:
    """Store a constraint; refused while rows of the table violate it. A name that is there is replaced."""
    require(sinks.read(spark, path), [constraint])
    _note(spark, path, constraint, False)


def drop_constraint(spark: SparkSession, path: str, name: str) -> None:
    if name not in {c.name for c in constraints(spark, path)}:
        raise KeyError(f"no constraint {name} at {path}")
    _note(spark, path, Constraint(name, "true"), True)


def listed(spark: SparkSession, path: str) -> DataFrame:
    return spark.createDataFrame([(c.name, c.expression) for c in constraints(spark, path)], "name string, expression string")


def checked(df: DataFrame, path: str) -> DataFrame:
    """``df`` with the table's constraints asserted in its plan."""
    return asserted(df, constraints(df.sparkSession, path))


def append(df: DataFrame, path: str) -> None:
    """Append a batch whose columns and rows the table allows, whole or not at all."""
    schema = sinks.read(df.sparkSession, path).schema
    sinks.check_schema(df, schema)
    checked(df.select(*schema.names), path).write.mode("append").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    """Replace all rows. They are checked as they are written to the shared folder; only then do the old ones go."""
    spark = df.sparkSession
    good = checked(sinks.conform(df, sinks.read(spark, path).schema), path)
    pin(good, "checked").write.mode("overwrite").parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    sinks.replace_partitions(checked(df, path), path, partition_by)


def merge_into(path: str, source: DataFrame, on: list[str], partition_by: list[str], clauses=UPSERT, **options) -> None:
    """Merge; the rows of every partition that the source touches are checked before any is replaced."""
    spark = source.sparkSession
    sinks.merge_into(path, source, on, partition_by, clauses, check_rows=lambda df: asserted(df, constraints(spark, path)), **options)
