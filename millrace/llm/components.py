"""Connected components by alternating stars."""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin, planned_once

#: Up to this many links, what a round reads is known to be small before it runs; and links to a task then.
FEW_LINKS, LINKS_A_TASK = 100_000, 20_000


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node of ``links`` (``a``, ``b``).

    Each round hangs larger neighbours on the least one, then smaller ones, so
    the longest path shrinks by a constant factor; it ends when nothing moves.
    Both steps are a combined aggregate and a join that Spark can split at a
    hub. Edges live in the shared folder between rounds; only two numbers a
    round reach the driver. Rounds over few links are planned once; more are
    left to adaptive execution.
    """
    n = links.count()
    with planned_once(links.sparkSession, n // LINKS_A_TASK + 2) if n <= FEW_LINKS else nullcontext():
        return _settled(links, rounds)


def _settled(links: DataFrame, rounds: int) -> DataFrame:
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    before = None
    for _ in range(rounds):
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        moved = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = pin(moved.union(least.select("a", "m")).distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select("b", "b").distinct())
