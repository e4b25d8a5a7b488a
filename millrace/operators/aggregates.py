"""Grouping operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import SEGMENT, Ordered, attach


def pivot_counts(df: DataFrame, keys: list[str], column: str, values: list[str]) -> DataFrame:
    """One count column per listed value, zero where a key has none."""
    return df.groupBy(*keys).pivot(column, values).agg(F.count(F.lit(1))).fillna(0, subset=values)


def unpivot(
    df: DataFrame, ids: list[str], columns: list[str], name: str, value: str, keep_zero: bool = False
) -> DataFrame:
    long = df.unpivot(ids, columns, name, value)
    return long if keep_zero else long.where(F.col(value) > 0)


def salted_agg(
    df: DataFrame,
    keys: list[str],
    partial: dict[str, Column],
    final: dict[str, Column],
    salt_on: list[str],
    salts: int = 5,
) -> DataFrame:
    """Two-stage aggregate: first per (keys, salt), then per keys.

    The salt is a hash of ``salt_on``, so a retried task produces the same
    salts.  ``final`` combines the columns that ``partial`` produced."""
    salt = F.pmod(F.xxhash64(*salt_on), F.lit(salts))
    first = df.groupBy(*keys, salt.alias("_salt")).agg(*[c.alias(n) for n, c in partial.items()])
    return first.groupBy(*keys).agg(*[c.alias(n) for n, c in final.items()])


def collect_chunks(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    item: Column,
    name: str,
    chunk_rows: int = 100_000,
    **size,
) -> DataFrame:
    """Ordered list of ``item`` per key, cut into chunks of ``chunk_rows``.

    A key with up to ``chunk_rows`` rows gives one row, ``chunk`` 0; a larger
    key continues in chunks 1, 2, ...  No list outgrows a task and no row is
    lost."""
    ordered = Ordered(df.withColumn("_item", item), keys, order, **size).row_number("_rn")
    chunk = F.floor((F.col("_rn") - 1) / chunk_rows).cast("int")
    rows = ordered.df.withColumn("chunk", chunk)
    pair = F.struct("_rn", "_item")
    if ordered.split:
        # a group in one segment has its lists where its rows are; the few others meet once more
        rows = attach(rows, ordered.cut_groups(), keys, ["_is_cut"], small=True)
        parts = rows.where("_is_cut").groupBy(*keys, "chunk").agg(F.collect_list(pair).alias("_l"))
        local = rows.where("_is_cut is null").groupBy(*keys, SEGMENT, "chunk").agg(F.collect_list(pair).alias("_l"))
        lists = local.drop(SEGMENT).unionByName(parts)
    else:
        lists = rows.groupBy(*keys, "chunk").agg(F.collect_list(pair).alias("_l"))
    return lists.select(*keys, "chunk", F.transform(F.sort_array("_l"), lambda x: x["_item"]).alias(name))


def count_report(checks: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """One row per named DataFrame with its row count."""
    parts = [d.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows") for n, d in checks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
