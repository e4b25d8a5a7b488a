"""Projection, filtering and cleaning of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Address form accepted as a valid e-mail address (fixed value).
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def rename_cast(df: DataFrame, mapping: dict[str, tuple[str, str | None]]) -> DataFrame:
    """Select and rename columns: ``{old: (new, type or None)}``.  A value that
    cannot be cast becomes NULL."""
    return df.select(
        *[
            (F.col(old).try_cast(kind) if kind else F.col(old)).alias(new)
            for old, (new, kind) in mapping.items()
        ]
    )


def bucket(rules: list[tuple[Column | str, object]], default) -> Column:
    """Label of the first rule that holds, else ``default``."""
    out = F.lit(default)
    for condition, label in reversed(rules):
        condition = F.expr(condition) if isinstance(condition, str) else condition
        out = F.when(condition, F.lit(label)).otherwise(out)
    return out


def is_valid_email(column: str) -> Column:
    return F.col(column).rlike(EMAIL_PATTERN)


def digits(column: str) -> Column:
    return F.regexp_replace(column, "[^0-9]", "")


def fill_numbers(df: DataFrame, value=0) -> DataFrame:
    """Replace NULL in every numeric column."""
    return df.fillna(value)


def decimal_price(column: str) -> Column:
    """Text to DECIMAL(10,2); text that is no number gives NULL."""
    return F.col(column).try_cast("decimal(10,2)")


def split_returns(df: DataFrame, quantity: str, amount: str) -> tuple[DataFrame, DataFrame]:
    """Sales (positive quantity) and returns (negative, given as positive numbers)."""
    sales = df.where(F.col(quantity) > 0)
    returns = (
        df.where(F.col(quantity) < 0)
        .withColumn("returned_quantity", F.abs(quantity))
        .withColumn("returned_amount", F.abs(amount))
        .drop(quantity, amount)
    )
    return sales, returns


def latest(df: DataFrame, column: str) -> DataFrame:
    """Rows that hold the greatest value of ``column``.

    The maximum is one value, so it travels as a literal into the scan filter
    and prunes row groups there."""
    newest = df.agg(F.max(column)).first()[0]
    return df.where(F.col(column) == F.lit(newest))


def find_by_name(df: DataFrame, column: str, fragment: str, order: list[str]) -> DataFrame:
    """First row, in ``order``, whose name contains ``fragment`` in any case."""
    return df.where(F.lower(column).contains(fragment.lower())).orderBy(*order).limit(1)
