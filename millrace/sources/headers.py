"""CSV files whose columns come and go: each file is read by the names in its own first line."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..streaming.batches import kept
from ..streaming.runner import run_batches, write_batch

FILE, AT, HEADER = "_file", "_at", "_header"


def without_one(lines: DataFrame, header: str | None = None) -> DataFrame:
    """Lines without one copy of its header per file; a data line that equals the header stays.

    The header is the text given, or the column ``_header`` of each line.
    Copies are alike, so it does not matter which of them is left out."""
    named = F.lit(header) if header is not None else F.col(HEADER)
    rest = lines.where(F.col("value") != named)
    again = lines.where(F.col("value") == named).groupBy(*lines.columns).agg(F.count(F.lit(1)).alias("_n"))
    more = again.where("_n > 1").withColumn("_n", F.explode(F.sequence(F.lit(2), F.col("_n"))))
    return rest.unionByName(more.drop("_n"))


def by_header(lines: DataFrame, schema: StructType, sep: str = ",") -> DataFrame:
    """Rows of CSV lines (``value``, ``_file``, ``_at``: where the line's block starts) by the names of each file.

    Columns of ``schema`` come first, with its types, NULL where a file lacks
    them; other columns follow as text.  Only the different headers reach the
    driver, one plan for each.  Values must not hold line ends."""
    first = lines.where(F.col(AT) == 0).withColumn("_id", F.monotonically_increasing_id())
    heads = first.groupBy(FILE).agg(F.min_by("value", "_id").alias(HEADER))
    known, out = {f.name: f for f in schema.fields}, None
    for (header,) in heads.select(HEADER).distinct().orderBy(HEADER).collect():
        names = [n.strip() for n in next(csv.reader([header], delimiter=sep))]
        layout = StructType([StructField(n, known[n].dataType if n in known else StringType()) for n in names])
        body = without_one(lines.drop(AT).join(heads.where(F.col(HEADER) == header), FILE))
        rows = body.select(F.from_csv("value", layout.toDDL(), {"sep": sep}).alias("r")).select("r.*")
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        return lines.sparkSession.createDataFrame([], schema)
    new = [c for c in out.columns if c not in known]
    have = [F.col(f.name) if f.name in out.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return out.select(*have, *new)


def ingest_by_header(spark: SparkSession, src: str, schema: StructType | str, checkpoint: str, sink: str, sep: str = ",", **options) -> StreamingQuery:
    """Append the CSV files that arrived since the last run, each by its own header; read with ``evolved=True``."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    lines = spark.readStream.options(**options).text(src)
    lines = lines.select("value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(AT))

    def write(batch: DataFrame, batch_id: int) -> None:
        with kept(batch) as b:
            write_batch(by_header(b, schema, sep), batch_id, sink)

    return run_batches(lines, write, checkpoint)
