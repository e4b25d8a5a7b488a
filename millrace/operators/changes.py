"""Change feeds and versioned reads.

A change log is a DataFrame of row images with ``_change_type`` (insert,
update_preimage, update_postimage, delete), ``_commit_version`` and
``_commit_timestamp``.  The log is the only truth: a state is the last image of
every key up to a version, found by one aggregate that is combined before its
shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .merge import UPSERT, feed_rows, merge, resolve, update
from .setops import changed_rows

META = ["_change_type", "_commit_version", "_commit_timestamp"]


def baseline(df: DataFrame, version: int, timestamp: Column) -> DataFrame:
    """The commit that inserts all rows of ``df``."""
    return df.withColumns(
        {
            "_change_type": F.lit("insert"),
            "_commit_version": F.lit(version).cast("bigint"),
            "_commit_timestamp": timestamp,
        }
    )


def changes(log: DataFrame, start: int, end: int | None = None, types: list[str] | None = None) -> DataFrame:
    """Change rows from version ``start`` on, optionally up to ``end`` and of some types."""
    out = log.where(F.col("_commit_version") >= start)
    if end is not None:
        out = out.where(F.col("_commit_version") <= end)
    return out.where(F.col("_change_type").isin(types)) if types else out


def _known(key: str) -> Column:
    """A key column; a NULL in it is an error, as no later change could find its row."""
    return F.coalesce(F.col(key), F.raise_error(F.lit(f"NULL in key column {key} of a change log")))


def diff(before: DataFrame, after: DataFrame, keys: list[str], version: int, timestamp: Column) -> DataFrame:
    """The change rows that lead from one state to the other; a NULL in a key is an error."""
    columns = before.columns
    before, after = (df.withColumns({k: _known(k) for k in keys}) for df in (before, after))
    values = [c for c in columns if c not in keys]
    b = before.withColumn("_in_b", F.lit(True)).alias("b")
    a = after.select(*columns).withColumn("_in_a", F.lit(True)).alias("a")
    on = reduce(lambda x, y: x & y, [F.col(f"b.{k}") == F.col(f"a.{k}") for k in keys])
    same = reduce(
        lambda x, y: x & y, [F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}")) for c in values], F.lit(True)
    )
    action = (
        F.when(F.col("_in_b").isNull(), "insert")
        .when(F.col("_in_a").isNull(), "delete")
        .when(same, "keep")
        .otherwise("update")
    )
    pairs = b.join(a, on, "full_outer").select(
        action.alias("action"),
        F.struct(*[F.col(f"b.{c}") for c in columns]).alias("old"),
        F.struct(*[F.col(f"a.{c}") for c in columns]).alias("new"),
    )
    return feed_rows(pairs, version, timestamp)


def commit(
    target: DataFrame,
    source: DataFrame,
    on: list[str],
    version: int,
    timestamp: Column,
    clauses=UPSERT,
    track_changes: bool = True,
    **options,
) -> tuple[DataFrame, DataFrame | None]:
    """Merge and, when the table tracks changes, its change rows."""
    rows = resolve(target, source, on, clauses, **options)
    table = rows.where("action <> 'delete'").select("new.*")
    return table, feed_rows(rows, version, timestamp) if track_changes else None


def _rank(kind: Column) -> Column:
    """Order of the images of one key inside a commit: preimage first, the final one last."""
    return F.when(kind == "update_preimage", 0).when(kind == "delete", 1).otherwise(2)


def last_images(log: DataFrame, keys: list[str]) -> DataFrame:
    """The last image of every key in some change rows, with how it came about."""
    values = [c for c in log.columns if c not in META]
    at = F.struct("_commit_version", _rank(F.col("_change_type")))
    return (
        log.where("_change_type <> 'update_preimage'")
        .groupBy(*[_known(k).alias(f"_key{i}") for i, k in enumerate(keys)])
        .agg(F.max_by(F.struct(*values, *META), at).alias("r"))
        .select("r.*")
    )


def as_of(log: DataFrame, keys: list[str], version: int | None = None, timestamp=None) -> DataFrame:
    """The table as it was at a version or a time; the newest state by default.

    A NULL in a key of the log is an error."""
    if version is not None:
        log = log.where(F.col("_commit_version") <= version)
    if timestamp is not None:
        log = log.where(F.col("_commit_timestamp") <= F.lit(timestamp).cast("timestamp"))
    return last_images(log, keys).where("_change_type <> 'delete'").drop(*META)


def apply_feed(target: DataFrame, feed: DataFrame, keys: list[str]) -> DataFrame:
    """Bring a downstream table up to date with a feed.

    Each key takes its last image of the feed, so a key may change in several
    commits; preimages are skipped."""
    from .merge import delete, insert

    last = last_images(feed, keys)
    clauses = [delete("s._change_type = 'delete'"), update(), insert(when="s._change_type <> 'delete'")]
    return merge(target, last, keys, clauses, check=False, keyed=True)


def history(log: DataFrame) -> DataFrame:
    """One row per commit with its row counts and what kind of operation it was."""
    kind = F.col("_change_type")

    def n(name):
        return F.count(F.when(kind == name, 1))

    counts = log.groupBy("_commit_version").agg(
        F.max("_commit_timestamp").alias("_commit_timestamp"),
        n("insert").alias("inserted"),
        n("update_postimage").alias("updated"),
        n("delete").alias("deleted"),
    )
    return counts.withColumn("operation", operation())


def operation() -> Column:
    """What kind of commit it was, from its counts."""
    return (
        F.when((F.col("updated") == 0) & (F.col("deleted") == 0), "INSERT")
        .when((F.col("inserted") == 0) & (F.col("deleted") == 0), "UPDATE")
        .when((F.col("inserted") == 0) & (F.col("updated") == 0), "DELETE")
        .otherwise("MERGE")
    )


def restore(log: DataFrame, keys: list[str], version: int, new_version: int, timestamp: Column) -> DataFrame:
    """The commit that takes the table back to ``version``; history stays."""
    return diff(as_of(log, keys), as_of(log, keys, version=version), keys, new_version, timestamp)


def changed_keys(log: DataFrame, keys: list[str], version_a: int, version_b: int) -> DataFrame:
    """Keys whose row differs between two versions, including added and removed ones."""
    states = as_of(log, keys, version=version_a), as_of(log, keys, version=version_b)
    return changed_rows(*states).select(*keys).distinct()


def first_seen(log: DataFrame, keys: list[str], predicate: str) -> DataFrame:
    """First version in which a row satisfied ``predicate``, per key."""
    hits = log.where("_change_type in ('insert', 'update_postimage')").where(predicate)
    return hits.groupBy(*keys).agg(F.min("_commit_version").alias("first_version"))


def undo_where(log: DataFrame, keys: list[str], version: int, predicate: str) -> DataFrame:
    """The newest state with the rows that satisfy ``predicate`` (over ``t``) taken from ``version``."""
    now, then = as_of(log, keys), as_of(log, keys, version=version)
    return merge(now, then, keys, [update(when=predicate)], check=False)


def expire(log: DataFrame, keys: list[str], before: int) -> DataFrame:
    """Fold all commits up to version ``before`` into one snapshot commit.

    States from ``before`` on can still be read; older ones cannot."""
    old = log.where(F.col("_commit_version") <= before)
    stamp = old.agg(F.max("_commit_timestamp")).first()[0]
    snapshot = as_of(old, keys).withColumns(
        {
            "_change_type": F.lit("insert"),
            "_commit_version": F.lit(before).cast("bigint"),
            "_commit_timestamp": F.lit(stamp),
        }
    )
    return snapshot.select(*log.columns).unionByName(log.where(F.col("_commit_version") > before))
