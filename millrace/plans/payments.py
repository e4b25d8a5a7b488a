"""Payment monitoring: ingest, enrichment, risk rules, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import money_avg, money_sum
from ..operators.merge import merge
from ..sources.rescue import rescue_json
from ..streaming.joins import stream_enrich
from ..streaming.windows import stream_dedup_within

SCHEMA = (
    "txn_id STRING, customer_id STRING, merchant_id STRING, amount DOUBLE, currency STRING, "
    "channel STRING, ip_country STRING, timestamp TIMESTAMP"
)

# Points per risk rule and the score above which a payment is an alert.
RISK_POINTS = {
    "is_geo_mismatch": 30,
    "amount > 800": 20,
    "merchant_risk_score > 80": 25,
    "channel = 'mobile'": 15,
}
ALERT_ABOVE = 70
UNKNOWN = {"customer_name": "Unknown Customer", "customer_country": "Unknown"}
UNKNOWN_MERCHANT = {"merchant_name": "Unknown Merchant", "merchant_country": "Unknown"}


def bronze(lines: DataFrame, retry_window: str = "10 minutes") -> DataFrame:
    """Payments from JSON lines; misfits are rescued, retries within the window dropped.

    A line without id or time cannot be a known retry: it bypasses the
    deduplication, whose watermark would drop it."""
    rows = rescue_json(lines, SCHEMA)
    known = "txn_id is not null and timestamp is not null"
    once = stream_dedup_within(rows.where(known), ["txn_id"], "timestamp", retry_window)
    return once.unionByName(rows.where(f"not ({known})"))


def silver(
    payments: DataFrame, customers: DataFrame, merchants: DataFrame, through: tuple[DataFrame, str] | None = None
) -> DataFrame:
    """Payments with both dimensions; a country comparison with NULL stays NULL.

    ``through`` names orders and their key, where only the orders hold the customer: each order, not each
    payment, is sent to its customer. Payments without an order drop out. Countries are compared before the
    second join, which need not send them where nothing else asks for them."""
    if through is None:
        out = stream_enrich(payments, customers, "customer_id", "left", defaults=UNKNOWN)
    else:
        orders, key = through
        out = payments.join(stream_enrich(orders, customers, "customer_id", "left", defaults=UNKNOWN), key)
    out = out.withColumn("is_geo_mismatch", F.col("ip_country") != F.col("customer_country"))
    out = stream_enrich(out, merchants, "merchant_id", "left", defaults=UNKNOWN_MERCHANT)
    return out.select(*[c for c in out.columns if c != "is_geo_mismatch"], "is_geo_mismatch").withColumn("currency", F.upper("currency"))


def upsert_merchants(merchants: DataFrame, updates: DataFrame) -> DataFrame:
    return merge(merchants, updates, ["merchant_id"], keyed=True)


def score(payments: DataFrame) -> DataFrame:
    """Sum of the points of all rules that hold; a rule that is NULL gives none."""
    total = F.lit(0)
    for condition, points in RISK_POINTS.items():
        total = total + F.when(F.expr(condition), points).otherwise(0)
    return payments.withColumn("risk_score", total).withColumn("is_alert", F.col("risk_score") > ALERT_ABOVE)


def alerts(payments: DataFrame) -> DataFrame:
    return score(payments).where("is_alert")


def daily_report(payments: DataFrame) -> DataFrame:
    return payments.groupBy(F.to_date("timestamp").alias("report_date"), "category_code").agg(
        F.count(F.lit(1)).alias("total_txns"),
        money_sum("amount").alias("total_amount"),
        money_avg("amount").alias("avg_amount"),
    )


def suspicious_customers(alerted: DataFrame) -> DataFrame:
    return alerted.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_incidents"),
        money_sum("amount").alias("total_suspicious_amount"),
        F.max("risk_score").alias("max_risk_score"),
    )
