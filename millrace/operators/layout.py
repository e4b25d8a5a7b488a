"""File layout: statistics, compaction, clustering, Z-order and what a lookup must read."""

from __future__ import annotations

import math
import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _files(df: DataFrame) -> DataFrame:
    """One row per file with its size and number of rows."""
    return df.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """Number of files, bytes and rows of a table."""
    return _files(spark.read.parquet(path)).agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")
    )


def compact(spark: SparkSession, path: str, out: str, target_bytes: int = 256 * 1024 * 1024) -> tuple[int, int]:
    """Rewrite a table into files of about ``target_bytes``; returns file counts before and after."""
    before = file_stats(spark, path).first()
    parts = max(1, math.ceil((before["bytes"] or 0) / target_bytes))
    spark.read.parquet(path).repartition(parts).write.parquet(out)
    return before["files"], file_stats(spark, out).first()["files"]


def _spread(df: DataFrame) -> Column:
    """Last sort key: splits rows that are equal in the clustering columns over several files."""
    plain = [f.name for f in df.schema if f.dataType.typeName() not in ("map", "variant")]
    return F.xxhash64(*plain)


def cluster(df: DataFrame, columns: list[str], parts: int) -> DataFrame:
    """Rows ranged and sorted by 1 to 4 columns, so files cover narrow value ranges.

    A value that holds much of the data is split over several files by a hash
    of the row."""
    if not 1 <= len(columns) <= 4:
        raise ValueError("cluster by 1 to 4 columns")
    tie = "_spread"
    ranged = df.withColumn(tie, _spread(df)).repartitionByRange(parts, *columns, tie)
    return ranged.sortWithinPartitions(*columns).drop(tie)


def write_clustered(df: DataFrame, path: str, columns: list[str], parts: int) -> None:
    """Write a table clustered by ``columns``; other columns next time means a rewrite."""
    cluster(df, columns, parts).write.mode("overwrite").parquet(path)


def zorder(df: DataFrame, columns: list[str], parts: int, bits: int = 8) -> DataFrame:
    """Rows ordered along a Z-curve over ``columns``.

    Each column is cut at its approximate quantiles into ``2**bits`` buckets;
    the bits of the bucket numbers are interleaved.  A text counts by the seven
    bytes after the prefix that all its values share."""
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    given, texts = df.columns, [c for c in columns if df.schema[c].dataType.typeName() in ("string", "varchar", "char")]
    if texts:
        ends = df.agg(*[f(c).alias(f"{n}_{c}") for c in texts for n, f in (("lo", F.min), ("hi", F.max))]).first()
        shared = {c: _shared_bytes(ends[f"lo_{c}"], ends[f"hi_{c}"]) for c in texts}
        df = df.withColumns({f"_t_{c}": _text_rank(c, n) for c, n in shared.items()})
        columns = [f"_t_{c}" if c in texts else c for c in columns]
    cuts = df.agg(*[F.percentile_approx(c, steps, 10_000).alias(f"c{i}") for i, c in enumerate(columns)]).first()

    def at_or_below(bounds: Column, column: str) -> Column:
        return F.size(F.filter(bounds, lambda b: b <= F.col(column)))

    def bucket(column: str, bounds: list) -> Column:
        """Number of bounds at or below the value, looked up in two steps of about 16."""
        bounds = sorted(set(bounds))
        if not bounds:
            return F.lit(0)
        step = math.ceil(math.sqrt(len(bounds)))
        runs = [bounds[i : i + step] for i in range(0, len(bounds), step)]
        run = at_or_below(F.array(*[F.lit(r[0]) for r in runs]), column)
        inside = F.element_at(F.array(*[F.array(*[F.lit(v) for v in r]) for r in runs]), F.greatest(run, F.lit(1)))
        return F.when(run > 0, (run - 1) * step + at_or_below(inside, column)).otherwise(0)

    # buckets become columns of their own first, so that each is computed once per row
    df = df.withColumns({f"_b{i}": bucket(c, cuts[f"c{i}"] or []) for i, c in enumerate(columns)})
    buckets = [F.col(f"_b{i}") for i in range(len(columns))]
    z = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, bucket in enumerate(buckets):
            one = F.shiftright(bucket, bit).bitwiseAND(F.lit(1)).cast("bigint")
            z = z + F.shiftleft(one, bit * len(buckets) + i)
    df = df.withColumns({"_z": z, "_spread": _spread(df)}).drop(*[f"_b{i}" for i in range(len(columns))])
    ranged = df.repartitionByRange(parts, "_z", "_spread")
    return ranged.sortWithinPartitions("_z").select(*given)


def _shared_bytes(lo: str | None, hi: str | None) -> int:
    """Bytes that the least and the greatest text, and so all between them, begin with."""
    return len(os.path.commonprefix([(lo or "").encode(), (hi or "").encode()]))


def _text_rank(column: str, skip: int) -> Column:
    """A number that rises with the seven bytes of a text after the first ``skip``."""
    part = F.hex(F.substring(F.encode(F.col(column), "UTF-8"), skip + 1, 7))
    return F.conv(F.rpad(part, 14, "0"), 16, 10).cast("bigint")


def write_sized(df: DataFrame, path: str, rows_per_file: int) -> None:
    """Even out the partitions at run time and cap the rows per file."""
    df.hint("rebalance").write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def migrate_layout(spark: SparkSession, src: str, dst: str, columns: list[str], parts: int) -> int:
    """Copy a table into a clustered layout; raises when the row counts differ."""
    rows = spark.read.parquet(src)
    write_clustered(rows, dst, columns, parts)
    before, after = rows.count(), spark.read.parquet(dst).count()
    if before != after:
        raise RuntimeError(f"{before} rows became {after}")
    return after


def scan_cost(spark: SparkSession, layouts: dict[str, str], lookup: dict[str, object]) -> DataFrame:
    """Per layout: files and bytes, how many of them a lookup can touch, and its rows.

    A file can be skipped when a looked-up value lies outside the range of the
    file's values."""
    out = None
    for name, path in layouts.items():
        table = spark.read.parquet(path)
        per_file = table.groupBy(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
        ).agg(
            *[F.min(c).alias(f"lo_{c}") for c in lookup],
            *[F.max(c).alias(f"hi_{c}") for c in lookup],
            F.count(F.when(reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in lookup.items()]), 1)).alias("hits"),
        )
        touched = reduce(
            lambda a, b: a & b,
            [(F.col(f"lo_{c}") <= F.lit(v)) & (F.col(f"hi_{c}") >= F.lit(v)) for c, v in lookup.items()],
        )
        row = per_file.agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("bytes").alias("bytes"),
            F.count(F.when(touched, 1)).alias("files_touched"),
            F.coalesce(F.sum(F.when(touched, F.col("bytes"))), F.lit(0)).alias("bytes_touched"),
            F.sum("hits").alias("rows_found"),
        ).select(F.lit(name).alias("layout"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def analyze(spark: SparkSession, table: str, columns: list[str] | None = None) -> None:
    """Statistics for the cost-based optimizer."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    if columns:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
