"""Joins of a stream with a table and with another stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def stream_enrich(
    stream: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "inner",
    columns: list[str] | None = None,
    where: Column | str | None = None,
    defaults: dict[str, object] | None = None,
) -> DataFrame:
    """Join a stream to a static table, which each run reads anew.

    ``where`` filters the table before the join.  Whether the table is broadcast is left
    to Spark's own check of its size.  The stream must stay on the preserved
    side, so right and full outer joins are refused."""
    if how not in ("inner", "left", "left_outer", "left_semi"):
        raise ValueError(f"{how} join would have to emit table rows that no stream row matches, which never is certain")
    if where is not None:
        dim = dim.where(where)
    if columns is not None:
        dim = dim.select(key, *[c for c in columns if c != key])
    out = stream.join(dim, key, how)
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in (defaults or {}).items()})


def time_bound(left_ts: str, right_ts: str, upper: str) -> Column:
    """The right row comes no earlier than the left one and at most ``upper`` later."""
    return (F.col(right_ts) >= F.col(left_ts)) & (F.col(right_ts) <= F.col(left_ts) + F.expr(f"interval {upper}"))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: tuple[str, str],
    times: tuple[str, str],
    upper: str | None = None,
    delays: tuple[str | None, str | None] = ("10 minutes", "10 minutes"),
    how: str = "inner",
) -> DataFrame:
    """Join two streams on a key within a time bound.

    Watermarks and bound together let Spark drop old state.  An outer join
    emits an unmatched row with NULLs once the watermark, the smaller of the
    two, has passed the last moment at which a match could have come."""
    for problem in lint_stream_join(upper, delays, how):
        if how != "inner":
            raise ValueError(problem)
    if delays[0]:
        left = left.withWatermark(times[0], delays[0])
    if delays[1]:
        right = right.withWatermark(times[1], delays[1])
    on = F.col(keys[0]) == F.col(keys[1])
    return left.join(right, on & time_bound(*times, upper) if upper else on, how)


def lint_stream_join(upper: str | None, delays: tuple[str | None, str | None], how: str = "inner") -> list[str]:
    """Why the state of such a join would grow without bound; empty when it would not."""
    problems = []
    for side, delay in zip(("left", "right"), delays):
        if not delay:
            problems.append(f"the {side} side has no watermark: its rows are kept forever")
    if not upper:
        problems.append(f"no time bound in the {how} join condition: no row can be known to be unmatched for good")
    return problems


def out_of_bounds(joined: DataFrame, left_ts: str, right_ts: str, upper: str) -> DataFrame:
    """Joined rows outside the bound; a correct interval join has none."""
    matched = joined.where(F.col(left_ts).isNotNull() & F.col(right_ts).isNotNull())
    return matched.where(~time_bound(left_ts, right_ts, upper))
