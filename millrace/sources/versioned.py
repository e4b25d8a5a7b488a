"""A table kept as a log of changes with a snapshot every few commits.

Below the path of the table:

``log/_commit_version=N``   the change rows of one commit
``snapshots/version=N``     the whole table as it was at some versions
``commits/version=N``       one row: when, how many rows, whether there is a snapshot

The row in ``commits`` is written last, so a commit that broke off does not
exist, and repeating it replaces what it left.  A state is the last snapshot at
or below its version with the few commits after it laid over: Spark reads those
folders and no others, whatever the age of the table.  One writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ..operators import changes as C
from ..operators.merge import UPSERT, feed_rows, merge, resolve, update
from ..operators.setops import changed_rows
from .storage import exists, remove

COMMIT = "version long, timestamp timestamp, inserted long, updated long, deleted long, snapshot boolean"


class UnknownVersion(ValueError):
    """A version that the table never had, or that has expired."""


@dataclass(frozen=True)
class VersionedTable:
    """``keys`` name a row and are never NULL; a snapshot is written every ``every`` commits."""

    spark: SparkSession
    path: str
    schema: StructType
    keys: tuple[str, ...]
    every: int = 10

    # -- what is stored ----------------------------------------------------

    @staticmethod
    def create(df: DataFrame, path: str, keys: list[str], timestamp: Column, every: int = 10) -> VersionedTable:
        """Version 0: the rows of ``df``, as inserts and as a snapshot."""
        table = VersionedTable(df.sparkSession, path, df.schema, tuple(keys), every)
        if exists(df.sparkSession, f"{path}/commits"):
            raise ValueError(f"there is a table at {path}")
        table._commit(C.baseline(df, 0, timestamp), 0)
        return table

    def log(self) -> DataFrame:
        """All change rows, partitioned by version."""
        fields = [f for f in self.schema.fields] + [StructField("_change_type", StringType()), StructField("_commit_timestamp", TimestampType())]
        schema = StructType([*fields, StructField("_commit_version", LongType())])
        log = self.spark.read.schema(schema).parquet(f"{self.path}/log")
        known = self.commits().agg(F.max("version"), F.min("version")).first()
        names = [*self.schema.names, *C.META]
        return log.where(F.col("_commit_version").between(known[1], known[0])).select(*names)

    def commits(self) -> DataFrame:
        """One row per version that can be read."""
        return self.spark.read.schema(COMMIT).parquet(f"{self.path}/commits")

    def last(self) -> int:
        return self.commits().agg(F.max("version")).first()[0]

    def snapshot(self, version: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/snapshots/version={version}")

    # -- writing -----------------------------------------------------------

    def _commit(self, feed: DataFrame, version: int) -> int:
        target = f"{self.path}/log/_commit_version={version}"
        names = [*self.schema.names, "_change_type", "_commit_timestamp"]
        feed.select(*names).write.mode("overwrite").parquet(target)
        kind = F.col("_change_type")
        counts = self.spark.read.schema(feed.select(*names).schema).parquet(target).agg(
            F.max("_commit_timestamp").alias("timestamp"),
            *[F.count(F.when(kind == k, 1)).alias(n) for k, n in (("insert", "inserted"), ("update_postimage", "updated"), ("delete", "deleted"))],
        )
        due = version % self.every == 0
        if due:
            change = self.spark.read.schema(feed.select(*names).schema).parquet(target).withColumn("_commit_version", F.lit(version).cast("long"))
            self._write_snapshot(change if version == 0 else self._over(version - 1, change), version, version == 0)
        row = counts.select(F.lit(version).cast("long").alias("version"), "timestamp", "inserted", "updated", "deleted", F.lit(due).alias("snapshot"))
        self._write_row(row, version)
        return version

    def _write_snapshot(self, state: DataFrame, version: int, first: bool = False) -> None:
        rows = C.as_of(state, list(self.keys)) if first else state
        rows.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/snapshots/version={version}")

    def _write_row(self, row: DataFrame, version: int) -> None:
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/version={version}")

    def append_feed(self, feed: DataFrame) -> int:
        """Store change rows as the next version, which must be the version they name."""
        return self._commit(feed, self.last() + 1)

    def merge(self, source: DataFrame, timestamp: Column, clauses=UPSERT, **options) -> int:
        """Merge into the newest state; its change rows are the next version."""
        version = self.last() + 1
        rows = resolve(self.state(), source, list(self.keys), clauses, keyed=True, **options)
        return self._commit(feed_rows(rows, version, timestamp), version)

    # -- reading -----------------------------------------------------------

    def version_at(self, timestamp) -> int:
        """The newest version committed at or before a time."""
        found = self.commits().where(F.col("timestamp") <= F.lit(timestamp).cast("timestamp")).agg(F.max("version")).first()[0]
        if found is None:
            raise UnknownVersion(f"no version as old as {timestamp}")
        return found

    def state(self, version: int | None = None, timestamp=None) -> DataFrame:
        """The table at a version or a time, the newest by default."""
        if timestamp is not None:
            version = self.version_at(timestamp)
        commits = self.commits()
        if version is not None:
            commits = commits.where(F.col("version") <= version)
        got = commits.agg(F.max("version").alias("version"), F.max(F.when(F.col("snapshot"), F.col("version"))).alias("base")).first()
        if got.base is None or version is not None and got.version != version:
            raise UnknownVersion(f"no version {version}")
        base = self.snapshot(got.base)
        return base if got.base == got.version else self._lay(base, self.feed(got.base + 1, got.version))

    def _over(self, version: int, change: DataFrame) -> DataFrame:
        return self._lay(self.state(version), change)

    def _lay(self, base: DataFrame, feed: DataFrame) -> DataFrame:
        """A snapshot with later changes laid over. Only the changes are grouped; the snapshot is not if they are few."""
        keys = list(self.keys)
        last = C.last_images(feed, keys)
        kept = base.join(last.select(*keys), keys, "left_anti").select(*self.schema.names)
        return kept.unionByName(last.where("_change_type <> 'delete'").select(*self.schema.names))

    def feed(self, start: int, end: int | None = None, types: list[str] | None = None) -> DataFrame:
        """Change rows of some versions; other versions are not opened."""
        return C.changes(self.log(), start, end, types)

    def history(self) -> DataFrame:
        """One row per commit with its counts and kind; change rows are not read."""
        rows = self.commits().select(F.col("version").alias("_commit_version"), F.col("timestamp").alias("_commit_timestamp"), "inserted", "updated", "deleted")
        return rows.withColumn("operation", C.operation())

    def touched(self, after: int, to: int) -> DataFrame:
        """Keys of rows that changed after one version, up to another."""
        low, high = sorted((after, to))
        return self.feed(low + 1, high).select(*self.keys).distinct()

    def changed_keys(self, version_a: int, version_b: int) -> DataFrame:
        """Keys whose row differs between two versions: only keys with a change in between are compared."""
        keys = list(self.keys)
        some = self.touched(version_a, version_b)
        a, b = (self.state(v).join(some, keys, "left_semi") for v in (version_a, version_b))
        return changed_rows(a, b).select(*keys).distinct()

    def restore(self, version: int, timestamp: Column) -> int:
        """Take the table back to a version by a new commit; only rows changed since are compared."""
        keys, now = list(self.keys), self.last()
        some = self.touched(version, now)
        before, after = (self.state(v).join(some, keys, "left_semi") for v in (now, version))
        return self._commit(C.diff(before, after, keys, now + 1, timestamp), now + 1)

    def undo_where(self, version: int, predicate: str) -> DataFrame:
        """The newest state with the rows that satisfy ``predicate`` (over ``t``) taken from ``version``.

        A row is looked up in the old version only if it changed since."""
        keys = list(self.keys)
        then = self.state(version).join(self.touched(version, self.last()), keys, "left_semi")
        return merge(self.state(), then, keys, [update(when=predicate)], check=False, keyed=True)

    def apply_to(self, target: DataFrame, since: int) -> DataFrame:
        """A copy that stands at version ``since``, brought up to date."""
        return C.apply_feed(target, self.feed(since + 1), list(self.keys))

    # -- expiry ------------------------------------------------------------

    def expire(self, before: int) -> None:
        """Forget versions older than ``before``, which becomes the first.

        First that version is marked as a snapshot, then the folders of each
        older one go, its row last, and at the end its own changes become
        inserts.  Broken off anywhere, it can be repeated; versions from
        ``before`` on can be read all the time."""
        found = self.commits().where(F.col("version") == before).first()
        if found is None:
            raise UnknownVersion(f"no version {before}")
        if not found.snapshot:
            self._write_snapshot(self.state(before), before)
            row = self.spark.createDataFrame([found], self.commits().schema).withColumn("snapshot", F.lit(True))
            self._write_row(row, before)
        for old in self.commits().where(F.col("version") < before).select("version").orderBy("version").collect():
            for folder in (f"log/_commit_version={old.version}", f"snapshots/version={old.version}", f"commits/version={old.version}"):
                remove(self.spark, f"{self.path}/{folder}")
        stamp = F.lit(found.timestamp)
        feed = self.snapshot(before).withColumns({"_change_type": F.lit("insert"), "_commit_timestamp": stamp})
        feed.write.mode("overwrite").parquet(f"{self.path}/log/_commit_version={before}")
        none = F.lit(0).cast("long")
        row = feed.agg(F.count(F.lit(1)).alias("inserted")).select(
            F.lit(before).cast("long").alias("version"), stamp.alias("timestamp"), "inserted", none.alias("updated"), none.alias("deleted"), F.lit(True).alias("snapshot")
        )
        self._write_row(row, before)
