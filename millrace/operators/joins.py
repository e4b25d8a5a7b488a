"""Join operators.

Equi-joins leave the strategy to Spark: it broadcasts a side whose size it has
checked and, with adaptive execution, splits skewed partitions of shuffled
joins.  Nothing here forces a broadcast without a bound.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import top_n

def left_enrich(
    df: DataFrame, dim: DataFrame, key: str | list[str], defaults: dict[str, object] | None = None
) -> DataFrame:
    """Left outer join to ``dim``; a missing dimension value becomes its default."""
    out = df.join(dim, key, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in (defaults or {}).items()})


def orphans(child: DataFrame, parent: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Rows of ``child`` without a parent, each (child column, parent column) equal.

    A left anti join: unlike ``NOT IN``, one NULL in the parent hides nothing."""
    condition = reduce(lambda a, b: a & b, [child[c] == parent[p] for c, p in on])
    return child.join(parent, condition, "left_anti")


def with_match(df: DataFrame, other: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    condition = reduce(lambda a, b: a & b, [df[c] == other[p] for c, p in on])
    return df.join(other, condition, "left_semi")


def group_members(df: DataFrame, keys: list[str], order: list[str], **size) -> DataFrame:
    """Rows that share their keys with others, with ``group_size`` and ``position`` in the group from 1.

    What a self-join would show of a group in pairs, in one row per member: two
    rows belong together when their keys are equal.  Rows with a NULL key are
    left out."""
    from .ordered import Ordered, attach

    kept = df.dropna(subset=keys)
    sizes = kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    shared = attach(kept, sizes, keys, ["group_size"]).where("group_size is not null")
    return Ordered(shared, keys, order, **size).row_number("position").result()


def linked_pairs(df: DataFrame, keys: list[str], order: list[str], columns: list[str], **size) -> DataFrame:
    """Each row of a group with the row before it, as ``<column>_1`` and ``<column>_2``.

    Rows that share ``keys`` are linked into a chain (n - 1 pairs for n rows)
    instead of all n(n-1)/2 pairs, whose number explodes on a hot group."""
    from .ordered import Ordered

    kept = df.dropna(subset=keys)
    chained = Ordered(kept, keys, order, **size).previous("_p", F.struct(*columns)).result()
    return chained.where("_p is not null").select(
        *keys,
        *[F.col(f"_p.{c}").alias(f"{c}_1") for c in columns],
        *[F.col(c).alias(f"{c}_2") for c in columns],
    )


def best_line(lines: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Best row per group of a joined detail table."""
    return top_n(lines, keys, order, 1)


def star(fact: DataFrame, dims: Iterable[tuple[DataFrame, str, str]], how: str = "inner") -> DataFrame:
    """Join a fact table to its dimensions, each given as (dim, fact key, dim key)."""
    out = fact
    for dim, fact_key, dim_key in dims:
        out = out.join(dim, F.col(fact_key) == F.col(dim_key), how)
    return out


def diff_keys(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of two states with what happened to each: added, removed, changed or same."""
    values = [c for c in before.columns if c not in keys]
    a = before.withColumn("_in_a", F.lit(True)).alias("a")
    b = after.withColumn("_in_b", F.lit(True)).alias("b")
    on = reduce(lambda x, y: x & y, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys])
    equal = reduce(
        lambda x, y: x & y,
        [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in values],
        F.lit(True),
    )
    state = (
        F.when(F.col("_in_a").isNull(), "added")
        .when(F.col("_in_b").isNull(), "removed")
        .when(equal, "same")
        .otherwise("changed")
    )
    return a.join(b, on, "full_outer").select(
        *[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys], state.alias("state")
    )
