"""Slowly changing dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import Ordered
from .windows import top_n

#: End date of a version that is still valid.
OPEN_END = "9999-12-31"


def scd2_init(df: DataFrame, start: Column) -> DataFrame:
    """First version of every row."""
    return df.withColumns(
        {
            "is_current": F.lit(True),
            "effective_start_date": start.cast("date"),
            "effective_end_date": F.lit(OPEN_END).cast("date"),
            "version": F.lit(1),
        }
    )


def _any_change(columns: list[str]) -> Column:
    return reduce(
        lambda a, b: a | b, [~F.col(f"d.{c}").eqNullSafe(F.col(f"s.{c}")) for c in columns], F.lit(False)
    )


def scd2(dim: DataFrame, source: DataFrame, keys: list[str], tracked: list[str], effective: Column) -> DataFrame:
    """Apply a snapshot of changed rows to a versioned dimension.

    A changed current row is closed at ``effective`` and followed by a new
    version; a new key starts at version 1; everything else stays.  Running it
    again with the same source changes nothing.  ``source`` has one row per
    key, as have the current rows; history passes by without a shuffle."""
    attributes = [c for c in dim.columns if c in source.columns]
    fields = {f.name: f.dataType for f in dim.schema}
    d = dim.where("is_current").withColumn("_in_d", F.lit(True)).alias("d")
    s = source.withColumn("_in_s", F.lit(True)).alias("s")
    same_key = reduce(lambda a, b: a & b, [F.col(f"d.{k}") == F.col(f"s.{k}") for k in keys])
    in_d, in_s = F.col("_in_d").isNotNull(), F.col("_in_s").isNotNull()

    def row(values: dict[str, Column], base: str | None) -> Column:
        def pick(c):
            if c in values:
                return values[c]
            return F.col(f"{base}.{c}") if base else F.lit(None)

        return F.struct(*[pick(c).cast(fields[c]).alias(c) for c in dim.columns])

    opened = {c: F.col(f"s.{c}") for c in attributes} | {
        "is_current": F.lit(True),
        "effective_start_date": effective,
        "effective_end_date": F.lit(OPEN_END),
    }
    if "version" in fields:
        opened["version"] = F.coalesce(F.col("d.version"), F.lit(0)) + 1
    closed = {"is_current": F.lit(False), "effective_end_date": effective}
    rows = (
        F.when(in_d & in_s & _any_change(tracked), F.array(row(closed, "d"), row(opened, None)))
        .when(in_d, F.array(row({}, "d")))
        .otherwise(F.array(row(opened, None)))
    )
    touched = d.join(s, same_key, "full_outer").select(F.explode(rows).alias("r")).select("r.*")
    return dim.where("not is_current").unionByName(touched)


def current(dim: DataFrame) -> DataFrame:
    """The open version of every key."""
    if "__END_AT" in dim.columns:
        return dim.where("__END_AT is null")
    return dim.where("is_current")


def version_counts(dim: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one version."""
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("version_count")).where("version_count > 1")


def apply_changes(
    changes: DataFrame,
    keys: list[str],
    seq: str,
    scd: int = 2,
    track: list[str] | None = None,
    ignore_nulls: bool = False,
    exclude: list[str] = (),
    tie: list[str] = (),
    **size,
) -> DataFrame:
    """Fold a stream of row changes into the latest state (1) or its history (2).

    ``seq`` orders the changes of a key, ``tie`` decides among equal ones;
    without ``tie`` a history with equal ones is an error.
    With ``ignore_nulls`` a NULL leaves the earlier value in place.  A change
    in a tracked column opens a new version; other columns are updated in the
    open one.  ``__START_AT`` is the first ``seq`` of a version, ``__END_AT``
    the start of the next one."""
    values = [c for c in changes.columns if c not in keys and c != seq]
    kept = [c for c in values if c not in exclude]
    order = [seq, *tie]
    if scd == 1 and not ignore_nulls:
        newest = top_n(changes, keys, [f"-{c}" for c in order], 1)
        return newest.select(*keys, *kept, *([] if seq in exclude else [seq]))
    at = F.struct(*order)
    if scd == 1:
        # last non-NULL value per column, combined before the shuffle
        latest = [F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in kept]
        out = changes.groupBy(*keys).agg(*latest, F.max(seq).alias(seq))
        return out.drop(seq) if seq in exclude else out
    rows = Ordered(changes, keys, order, **size)
    if ignore_nulls:
        rows.fill_forward(kept)
    tracked = [c for c in (track or kept) if c in kept]
    # the marker is NULL only before the first row of a key
    image = F.struct(F.lit(1).alias("_row"), *tracked)
    rows.previous("_before", F.struct(image.alias("image"), F.col(seq).alias("at")))
    opens = ~F.col("_before.image").eqNullSafe(image)
    if not tie:
        undecided = F.raise_error(F.concat(F.lit(f"two changes of a key with {seq} "), F.col(seq).cast("string")))
        opens = F.when(F.col("_before.at") == F.col(seq), undecided.cast("boolean")).otherwise(opens)
    rows.df = rows.df.withColumn("_new", opens.cast("int"))
    numbered = rows.running_sum("_version", F.col("_new")).result()
    versions = numbered.groupBy(*keys, "_version").agg(
        F.max_by(F.struct(*kept), at).alias("_row"), F.min(seq).alias("__START_AT")
    )
    size = size or {"bounded": not rows.split}
    ends = Ordered(versions, keys, ["-_version"], **size).previous("__END_AT", F.col("__START_AT")).result()
    return ends.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in kept], "__START_AT", "__END_AT")
