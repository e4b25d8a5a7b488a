"""Window operators: ranks, lags, running and rolling values, sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import Ordered, attach, ordering

#: Rows of a block of a rolling window.
BLOCK_ROWS = 1_000_000


def qualify(df: DataFrame, expression: Column, predicate: str) -> DataFrame:
    """Keep the rows whose window ``expression``, named ``w`` in ``predicate``, passes."""
    return df.withColumn("w", expression).where(predicate).drop("w")


def top_n(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """First ``n`` rows per group.

    ``row_number() <= n`` lets Spark cut every map task's share of a group to
    ``n`` rows before the shuffle, so a hot group costs no more than others."""
    by = Window.partitionBy(*keys).orderBy(*ordering(order))
    return qualify(df, F.row_number().over(by), f"w <= {int(n)}")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in ``order``; rows with a NULL key are left out."""
    return top_n(df.dropna(subset=keys), keys, order, 1)


def rank_by(
    df: DataFrame,
    order: list[str],
    keys: list[str] = (),
    rank: str | None = "rank_val",
    dense: str | None = None,
    rows_per_task: int | None = None,
    bounded: bool = False,
) -> DataFrame:
    """RANK and DENSE_RANK per group, or over all rows when there are no keys.

    The rows are first reduced to their distinct order values with a count
    each: the rank of a value is one plus the rows before it, its dense rank is
    its position."""
    keys = list(keys)
    wanted = {n: f for n, f in ((rank, F.rank), (dense, F.dense_rank)) if n}
    if bounded:
        by = Window.partitionBy(*(keys or [F.lit(1)])).orderBy(*ordering(order))
        return df.withColumns({n: f().over(by).cast("bigint") for n, f in wanted.items()})
    columns = [c.lstrip("-") for c in order]
    values = df.groupBy(*keys, *columns).agg(F.count(F.lit(1)).alias("_n"))
    placed = (
        Ordered(values, keys, order, rows_per_task)
        .running_sum("_upto", F.col("_n"))
        .row_number("_dense")
        .result()
    )
    joined = attach(df, placed, keys + columns, ["_upto", "_n", "_dense"])
    ranks = {rank: F.col("_upto") - F.col("_n") + 1, dense: F.col("_dense")}
    return joined.withColumns({n: ranks[n].cast("bigint") for n in wanted}).drop("_upto", "_n", "_dense")


def delta_prev(
    df: DataFrame, keys: list[str], order: list[str], value: str, previous: str, change: str, **size
) -> DataFrame:
    """Value of the row before and the difference to it."""
    out = Ordered(df, keys, order, **size).previous(previous, F.col(value)).result()
    return out.withColumn(change, F.col(value) - F.col(previous))


def running_total(
    df: DataFrame, keys: list[str], order: list[str], value: Column, name: str, **size
) -> DataFrame:
    return Ordered(df, keys, order, **size).running_sum(name, value).result()


def cumulative_share(
    df: DataFrame, keys: list[str], order: list[str], value: Column, name: str, **size
) -> DataFrame:
    """Running total of ``value`` in percent of the group's total."""
    total = "_group_total"
    with_total = group_total(df.withColumn("_value", value), keys, F.sum("_value"), total)
    out = running_total(with_total, keys, order, F.col("_value"), "_run", **size)
    return out.withColumn(
        name,
        F.try_divide(F.col("_run").cast("double") * 100, F.col(total).cast("double")),
    ).drop("_value", "_run", total)


def ntile_by(
    df: DataFrame, order: list[str], buckets: int, name: str, keys: list[str] = (), **size
) -> DataFrame:
    return Ordered(df, list(keys), order, **size).ntile(name, buckets).result()


def group_total(df: DataFrame, keys: list[str], aggregate: Column, name: str) -> DataFrame:
    """Attach a per-group aggregate.

    Aggregate and join rather than a window: the aggregate is combined before
    its shuffle, and adaptive execution can split a skewed side of the join."""
    return attach(df, df.groupBy(*keys).agg(aggregate.alias(name)), keys, [name])


def share_of(df: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """``value`` in percent of its group's total."""
    out = group_total(df.withColumn("_value", value), keys, F.sum("_value"), "_total")
    return out.withColumn(
        name, F.try_divide(F.col("_value").cast("double") * 100, F.col("_total").cast("double"))
    ).drop("_value", "_total")


def first_last(
    df: DataFrame, keys: list[str], order: list[str], columns: list[str]
) -> DataFrame:
    """First and last value of ``columns`` over the whole group, on every row.

    ``order`` must be ascending and total within the group."""
    at = F.struct(*order)
    ends = df.groupBy(*keys).agg(
        F.min_by(F.struct(*columns), at).alias("_first"),
        F.max_by(F.struct(*columns), at).alias("_last"),
    )
    return attach(df, ends, keys, ["_first", "_last"]).select(
        *df.columns,
        *[F.col(f"_first.{c}").alias(f"first_{c}") for c in columns],
        *[F.col(f"_last.{c}").alias(f"last_{c}") for c in columns],
    )


def sessionize(
    df: DataFrame, keys: list[str], ts: str, gap_seconds: int, order: list[str], name: str, **size
) -> DataFrame:
    """Number the sessions of each key from 1.

    A row starts a session when it is the first of its key or comes strictly
    more than ``gap_seconds`` after the row before."""
    rows = Ordered(df, keys, order, **size).previous("_before", F.col(ts))
    gap = F.timestamp_diff("MICROSECOND", F.col("_before").cast("timestamp"), F.col(ts).cast("timestamp"))
    starts = F.when(F.col("_before").isNull() | (gap > gap_seconds * 1_000_000), 1).otherwise(0)
    rows.df = rows.df.withColumn("_starts", starts)
    return rows.running_sum(name, F.col("_starts")).result().drop("_before", "_starts")


def rolling(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    rows: int,
    aggregates: dict[str, Column],
    rows_per_task: int | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Aggregates over the current row and the ``rows - 1`` before it.

    A group is cut by row number into blocks; each block also receives
    the last ``rows - 1`` rows of the block before it, which are dropped after
    the window has run."""
    if bounded:
        frame = (
            Window.partitionBy(*(keys or [F.lit(1)]))
            .orderBy(*ordering(order))
            .rowsBetween(1 - rows, 0)
        )
        return df.withColumns({n: a.over(frame) for n, a in aggregates.items()})
    block = max(rows_per_task or BLOCK_ROWS, rows)
    placed = Ordered(df, keys, order, rows_per_task).row_number("_rn").result()
    own = F.floor((F.col("_rn") - 1) / block)
    in_tail = (F.col("_rn") - 1) % block >= block - (rows - 1)
    copies = F.when(in_tail, F.array(own, own + 1)).otherwise(F.array(own))
    spread = placed.withColumn("_own", own).withColumn("_block", F.explode(copies))
    frame = Window.partitionBy(*keys, "_block").orderBy("_rn").rowsBetween(1 - rows, 0)
    return (
        spread.withColumns({n: a.over(frame) for n, a in aggregates.items()})
        .where("_block = _own")
        .drop("_rn", "_own", "_block")
    )
