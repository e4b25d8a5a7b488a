"""Writing tables.

A target is a table name or, when it contains a slash, a path of parquet files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.merge import UPSERT, merge
from ..session import pin


class SchemaMismatch(ValueError):
    """A batch does not have the columns and types of its table."""


def _is_path(target: str) -> bool:
    return "/" in target


def read(spark: SparkSession, target: str, evolved: bool = False) -> DataFrame:
    if _is_path(target):
        return spark.read.option("mergeSchema", evolved).parquet(target)
    return spark.table(target)


def write(
    df: DataFrame,
    target: str,
    mode: str = "overwrite",
    partition_by: list[str] = (),
    max_records_per_file: int | None = None,
) -> None:
    """Create, replace or extend a table.

    A partitioned write is first rebalanced on the partition columns: each
    value goes to few files, and adaptive execution splits a value that holds
    much of the data over several tasks."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(target) if _is_path(target) else writer.saveAsTable(target)


def append(df: DataFrame, target: str) -> None:
    write(df, target, "append")


def overwrite(df: DataFrame, target: str) -> None:
    """INSERT OVERWRITE: replace all rows, keep the table and its schema."""
    if _is_path(target):
        conform(df, read(df.sparkSession, target).schema).write.mode("overwrite").parquet(target)
    else:
        df.write.insertInto(target, overwrite=True)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of ``schema``: others are dropped, types are cast."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def check_schema(df: DataFrame, schema: StructType) -> None:
    """Raise unless ``df`` has no column beyond ``schema`` and no other type."""
    want = {f.name: f.dataType for f in schema.fields}
    extra = [f.name for f in df.schema if f.name not in want]
    other = [f.name for f in df.schema if f.name in want and f.dataType != want[f.name]]
    missing = [n for n in want if n not in df.columns]
    if extra or other or missing:
        raise SchemaMismatch(f"extra columns {extra}, other types {other}, missing columns {missing}")


def append_enforced(df: DataFrame, target: str) -> None:
    """Append; a batch with an extra column or another type is refused whole."""
    schema = read(df.sparkSession, target).schema
    check_schema(df, schema)
    append(df.select(*schema.names), target)


def append_evolve(df: DataFrame, path: str) -> None:
    """Append files that may have new columns; read them with ``evolved=True``."""
    have = {f.name: f.dataType for f in read(df.sparkSession, path, evolved=True).schema}
    other = [f.name for f in df.schema if have.get(f.name, f.dataType) != f.dataType]
    if other:
        raise SchemaMismatch(f"other types {other}")
    append(df, path)


def overwrite_schema(df: DataFrame, path: str) -> None:
    """Replace rows and schema."""
    df.write.mode("overwrite").parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions that ``df`` has rows for."""
    df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def merge_into(
    path: str, source: DataFrame, on: list[str], partition_by: list[str], clauses=UPSERT, check_rows=None, **options
) -> None:
    """Merge into a partitioned table, rewriting only the partitions the source touches.

    The partition columns must be among ``on``, so that a key never moves to
    another partition.  The table is joined to the partitions of the source,
    whose ranges also prune the read; all other partitions are neither read nor
    written.  A partition that the merge empties loses its folder.  Repeating
    a merge that broke off gives the same table, unless an update builds on the
    old value: then it may count twice.  ``check_rows`` is applied to the rows
    before any is replaced."""
    if not set(partition_by) <= set(on):
        raise ValueError("partition columns must be part of the key")
    spark = source.sparkSession
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    old = _touched(spark.read.parquet(path).withColumn("_folder", folder), source, partition_by)
    merged = merge(old.drop("_folder"), source, on, clauses, **options)
    result = pin(check_rows(merged) if check_rows else merged, "merged")
    left = result.select(*[F.col(c).alias(f"_s_{c}") for c in partition_by]).distinct()
    folders = old.select(*partition_by, "_folder").distinct()
    emptied = pin(folders.join(left, _same_partition(partition_by), "left_anti").select("_folder"), "emptied")
    replace_partitions(result, path, partition_by)
    for row in emptied.toLocalIterator():
        _remove(spark, row["_folder"])


def _same_partition(partition_by: list[str], null_safe: bool = True) -> Column:
    pairs = [(F.col(c), F.col(f"_s_{c}")) for c in partition_by]
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) if null_safe else x == y for x, y in pairs])


def _touched(table: DataFrame, source: DataFrame, partition_by: list[str]) -> DataFrame:
    """The table's rows in partitions that the source has rows for.

    One row of bounds reaches the driver.  Partitions without a NULL are joined
    by plain equality, which Spark can turn into pruning at run time."""
    named = source.select(*[F.col(c).alias(f"_s_{c}") for c in partition_by]).distinct()
    bounds = source.agg(*[f(c).alias(f"{n}_{c}") for c in partition_by for n, f in (("lo", F.min), ("hi", F.max))]).first()
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in partition_by])
    whole_s = reduce(lambda a, b: a & b, [F.col(f"_s_{c}").isNotNull() for c in partition_by])
    inside = whole
    for c in partition_by:
        inside = inside & F.col(c).between(F.lit(bounds[f"lo_{c}"]), F.lit(bounds[f"hi_{c}"]))
    full = table.where(inside).join(named.where(whole_s), _same_partition(partition_by, False), "left_semi")
    blank = table.where(~whole).join(named.where(~whole_s), _same_partition(partition_by), "left_semi")
    return full.unionByName(blank)


def _remove(spark: SparkSession, folder: str) -> None:
    """Remove one partition folder through the file system that holds it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
