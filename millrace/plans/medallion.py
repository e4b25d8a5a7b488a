"""Bronze, silver and gold layers of an order table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import money_avg, money_sum
from ..operators.merge import insert, merge, update
from ..operators.windows import latest_per_key


def bronze(raw: DataFrame, source: str, at: Column) -> DataFrame:
    """Raw rows with their origin and the time of ingestion."""
    return raw.withColumns({"_source": F.lit(source), "_ingested_at": at})


def silver_dedup(bronze_rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return latest_per_key(bronze_rows, keys, order)


def silver_clean(rows: DataFrame) -> DataFrame:
    """Rows with a customer and a positive amount; standard status, typed date."""
    return (
        rows.where("customer_id is not null and amount > 0")
        .withColumns({"status": F.upper(F.trim("status")), "order_date": F.col("order_date").cast("date")})
        .drop("_source", "_ingested_at")
    )


def gold_daily(silver: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders and revenue per day and region."""
    return (
        silver.join(customers.select("customer_id", "region"), "customer_id")
        .groupBy("order_date", "region")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            money_sum("amount").alias("total_revenue"),
            money_avg("amount").alias("avg_order_amount"),
        )
    )


def silver_increment(silver: DataFrame, batch: DataFrame, key: str, newest: list[str]) -> DataFrame:
    """Merge a bronze batch: its newest row per key wins when it is newer than the silver row."""
    clauses = [update(when="s.updated_at > t.updated_at"), insert()]
    return merge(silver, batch, [key], clauses, dedupe=newest, keyed=True)


def gold_increment(gold: DataFrame, new_silver: DataFrame, customers: DataFrame) -> DataFrame:
    """Replace the days and regions that the new rows touch."""
    return merge(gold, gold_daily(new_silver, customers), ["order_date", "region"], keyed=True, check=False)
