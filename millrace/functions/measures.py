"""Named measures and money arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str, scale: int = 2) -> Column:
    """A decimal: its sums do not depend on the order in which tasks finish."""
    return _col(c).cast(f"decimal(18,{scale})")


def money_sum(c: Column | str, scale: int = 2) -> Column:
    return F.sum(money(c, scale)).cast("double")


def money_avg(c: Column | str, scale: int = 2) -> Column:
    return F.try_divide(money_sum(c, scale), F.count(_col(c)))


def sum_when(condition: Column, value: Column | str) -> Column:
    return F.sum(F.when(condition, _col(value)).otherwise(0))


def count_when(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


# Measures of any table of sales lines, by name: what is asked for is one aggregate over the lines.

def line_measures(amount: str, order: str, buyer: str, at: str, units: str = "quantity") -> dict[str, Column]:
    """Measures over lines with an amount, an order id, a buyer, a time and a number of units."""
    revenue = money_sum(amount)
    return {
        "revenue": revenue,
        "units": F.sum(units),
        "lines": F.count(order),
        "orders": F.count_distinct(F.col(order)),
        "buyers": F.count_distinct(F.col(buyer)),
        "first_day": F.to_date(F.min(at)),
        "last_day": F.to_date(F.max(at)),
        "mean_line": money_avg(amount),
    }


def measured(df: DataFrame, by: list[str], measures: dict[str, Column], wanted: dict[str, str]) -> DataFrame:
    """Group by ``by``; ``wanted`` maps the names of result columns to measures."""
    return df.groupBy(*by).agg(*[measures[m].alias(name) for name, m in wanted.items()])


# The measures of the sales star (columns net_sales, gross_margin, quantity, order_id).

def total_revenue() -> Column:
    return F.sum("net_sales")


def total_margin() -> Column:
    return F.sum("gross_margin")


def margin_pct() -> Column:
    """Margin in percent of revenue; NULL when nothing was sold."""
    return F.try_divide(
        F.sum("gross_margin").cast("double") * 100, F.sum("net_sales").cast("double")
    )


def units_sold() -> Column:
    return F.sum("quantity")


def avg_order_value() -> Column:
    return F.try_divide(F.sum("net_sales").cast("double"), F.count_distinct(F.col("order_id")))


def is_discounted() -> Column:
    return F.col("discount_amount") > 0
