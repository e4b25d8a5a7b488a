"""Ordered per-group calculations, the same whether a group fits one task or not.

A plain window puts all rows of a group into one task.  ``Ordered`` sorts the
rows by group and order over all tasks instead, which cuts them into segments,
fixes that layout in the shared folder, runs the window inside each (group,
segment) and adds what earlier segments of the group carry over.  How many
segments there are follows the bytes that Spark has shuffled; nothing is
counted beforehand.  All columns that do not build on each other share one
window, one summary of the segments and one join with what they carry.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import pin

SEGMENT = _SEG = "_segment"


def ordering(order: list[str]) -> list[Column]:
    """``["day", "-amount"]`` -> day ascending, amount descending."""
    return [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in order]


def attach(
    df: DataFrame, other: DataFrame, keys: list[str], columns: list[str], small: bool = False
) -> DataFrame:
    """Left join ``columns`` of ``other`` onto ``df``; NULL keys equal each other."""
    side = other.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *columns)
    on = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.lit(True)
    )
    joined = df.join(F.broadcast(side) if small else side, on, "left")
    return joined.drop(*[f"_k{i}" for i in range(len(keys))])


class Ordered:
    """Adds order-dependent columns to ``df``, one method call per column."""

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], rows_per_task: int | None = None, bounded: bool = False):
        """``rows_per_task`` sets the size of segments by a count of the rows, instead of by bytes.

        ``bounded=True`` takes plain windows: the caller knows that no group
        can outgrow a task (for example one row per day)."""
        self.keys, self.order = list(keys), list(order)
        self.split = not bounded
        if self.split:
            spread = [F.asc(k) for k in self.keys] + ordering(self.order)
            parts = [max(2, math.ceil(df.count() / rows_per_task))] if rows_per_task else []
            df = pin(df.repartitionByRange(*parts, *spread).withColumn(_SEG, F.spark_partition_id()), "segments")
        self._df = df
        self._columns = 0
        self._clear()
        self._cut: DataFrame | None = None

    def cut_groups(self) -> DataFrame:
        """Keys of the groups that lie in several segments: fewer than there are segments, as each border cuts at most one."""
        if self._cut is None:
            ends = self._df.groupBy(*self.keys).agg(F.min(_SEG).alias("_from"), F.max(_SEG).alias("_to"))
            self._cut = pin(ends.where("_from < _to").select(*self.keys, F.lit(True).alias("_is_cut")), "cut")
        return self._cut

    def _clear(self) -> None:
        self._local: list[tuple[str, Column]] = []
        self._summary: dict[str, Column] = {}
        self._carry: dict[str, Column] = {}
        self._whole: dict[str, Column] = {}
        self._finish: list[tuple[str, Column]] = []
        self._drop: list[str] = []

    @property
    def df(self) -> DataFrame:
        """The rows with all columns asked for so far."""
        self._resolve()
        return self._df

    @df.setter
    def df(self, df: DataFrame) -> None:
        self._resolve()
        self._df = df

    def window(self) -> WindowSpec:
        local = self.keys + ([_SEG] if self.split else [])
        return Window.partitionBy(*(local or [F.lit(1)])).orderBy(*ordering(self.order))

    def result(self) -> DataFrame:
        return self.df.drop(_SEG)

    def _name(self) -> str:
        self._columns += 1
        return f"_o{self._columns}"

    def _resolve(self) -> None:
        """Compute the columns that wait: windows inside segments, one summary, one join with what is carried."""
        if not self._local:
            return
        local, summary, carry, whole, finish, drop = self._local, self._summary, self._carry, self._whole, self._finish, self._drop
        self._clear()
        df = self._df
        for name, column in local:
            df = df.withColumn(name, column)
        if self.split:
            group = Window.partitionBy(*(self.keys or [F.lit(1)]))
            earlier = group.orderBy(_SEG).rowsBetween(Window.unboundedPreceding, -1)
            rows = df
            if not whole:  # only groups in several segments are handed anything
                rows = attach(df, self.cut_groups(), self.keys, ["_is_cut"], small=True).where("_is_cut")
            # one row per group and segment
            segments = rows.groupBy(*self.keys, _SEG).agg(*[c.alias(n) for n, c in summary.items()])
            handed = segments.select(
                *self.keys,
                _SEG,
                *[c.over(earlier).alias(n) for n, c in carry.items()],
                *[c.over(group).alias(n) for n, c in whole.items()],
            )
            df = attach(df, handed, [*self.keys, _SEG], [*carry, *whole], small=not whole)
            for name, column in finish:
                df = df.withColumn(name, column)
            drop = [*drop, *carry, *whole]
        self._df = df.drop(*drop)

    # -- columns -----------------------------------------------------------

    def row_number(self, name: str) -> Ordered:
        i = self._name()
        self._local.append((name, F.row_number().over(self.window()).cast("bigint")))
        self._summary[f"{i}n"] = F.count(F.lit(1))
        self._carry[f"{i}rows"] = F.sum(f"{i}n")
        self._finish.append((name, F.col(name) + F.coalesce(f"{i}rows", F.lit(0))))
        return self

    def running_sum(self, name: str, value: Column) -> Ordered:
        """Running total over ROWS up to the current one."""
        i, frame = self._name(), self.window().rowsBetween(Window.unboundedPreceding, 0)
        self._local += [(f"{i}v", value), (name, F.sum(f"{i}v").over(frame))]
        self._summary[f"{i}s"] = F.sum(f"{i}v")
        self._carry[f"{i}sum"] = F.sum(f"{i}s")
        total = F.when(F.col(name).isNull(), F.col(f"{i}sum")).otherwise(F.col(name) + F.coalesce(F.col(f"{i}sum"), F.lit(0)))
        kind = self._df.select(F.sum(value)).schema[0].dataType
        self._finish.append((name, total.cast(kind)))
        self._drop.append(f"{i}v")
        return self

    def previous(self, name: str, value: Column) -> Ordered:
        """The value of the row before; NULL on the first row of a group."""
        i, by = self._name(), self.window()
        self._local += [(f"{i}v", value), (f"{i}at", F.row_number().over(by)), (name, F.lag(f"{i}v").over(by))]
        self._summary[f"{i}tail"] = F.max_by(F.struct(f"{i}v"), f"{i}at")
        self._carry[f"{i}before"] = F.last(f"{i}tail")
        self._finish.append((name, F.when(F.col(f"{i}at") == 1, F.col(f"{i}before.{i}v")).otherwise(F.col(name))))
        self._drop += [f"{i}v", f"{i}at"]
        return self

    def fill_forward(self, columns: list[str]) -> Ordered:
        """Replace NULL by the last value before it in the group."""
        self._resolve()  # the columns change: what was asked for before sees them as they were
        i, by = self._name(), self.window()
        frame = by.rowsBetween(Window.unboundedPreceding, 0)
        self._local.append((f"{i}at", F.row_number().over(by)))
        for k, c in enumerate(columns):
            self._local.append((c, F.last(c, ignorenulls=True).over(frame)))
            self._summary[f"{i}l{k}"] = F.max_by(c, f"{i}at")
            self._carry[f"{i}c{k}"] = F.last(f"{i}l{k}", ignorenulls=True)
            self._finish.append((c, F.coalesce(c, f"{i}c{k}")))
        self._drop.append(f"{i}at")
        self._resolve()
        return self

    def ntile(self, name: str, buckets: int) -> Ordered:
        """SQL NTILE: the first ``rows % buckets`` buckets hold one row more."""
        if not self.split:
            self._local.append((name, F.ntile(buckets).over(self.window())))
            return self
        i = self._name()
        self._local.append((f"{i}at", F.row_number().over(self.window()).cast("bigint")))
        self._summary[f"{i}n"] = F.count(F.lit(1))
        self._carry[f"{i}rows"] = F.sum(f"{i}n")
        self._whole[f"{i}all"] = F.sum(f"{i}n")
        place = F.col(f"{i}at") + F.coalesce(f"{i}rows", F.lit(0))
        small, more = F.expr(f"{i}all div {buckets}"), F.col(f"{i}all") % buckets
        head = more * (small + 1)
        bucket = F.when(place <= head, F.ceil(place / (small + 1))).otherwise(more + F.ceil(F.try_divide(place - head, small)))
        self._finish.append((name, bucket.cast("int")))
        self._drop.append(f"{i}at")
        return self
