"""Set operations between two states of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def changed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Distinct rows found in exactly one of the two states.

    Equal to EXCEPT in both directions, in one aggregate instead of two
    set differences: each distinct row is marked with the states that hold it."""
    columns = before.columns
    both = before.select(*columns, F.lit(1).alias("_side")).union(
        after.select(*columns, F.lit(2).alias("_side"))
    )
    sides = both.groupBy(*columns).agg(F.min("_side").alias("_lo"), F.max("_side").alias("_hi"))
    return sides.where("_lo = _hi").drop("_lo", "_hi")


def union_evolving(*frames: DataFrame) -> DataFrame:
    """UNION BY NAME; a column that a frame lacks is NULL there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
