"""Window queries."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.measures import money, money_sum
from ..operators import windows as W
from .registry import query


@query(
    "latest_per_key",
    "W1",
    """SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM orders
    QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def latest_per_key(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return W.latest_per_key(rows, ["o_custkey"], ["-o_orderdate", "-o_orderkey"])


@query(
    "rank_customers",
    "W2",
    """WITH n AS (SELECT o_custkey, COUNT(*) AS orders FROM orders GROUP BY o_custkey)
    SELECT o_custkey, orders, RANK() OVER (ORDER BY orders DESC) AS rank_val, DENSE_RANK() OVER (ORDER BY orders DESC) AS dense_rank_val FROM n""",
)
def rank_customers(t):
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    return W.rank_by(counts, ["-orders"], rank="rank_val", dense="dense_rank_val")


@query(
    "lag_change",
    "W3",
    """SELECT o_orderkey, o_custkey, LAG(CAST(o_totalprice AS DECIMAL(18,2))) OVER w::DOUBLE AS prev_amount,
    (CAST(o_totalprice AS DECIMAL(18,2)) - LAG(CAST(o_totalprice AS DECIMAL(18,2))) OVER w)::DOUBLE AS amount_change
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""".replace(
        "LAG(CAST(o_totalprice AS DECIMAL(18,2))) OVER w::DOUBLE", "CAST(LAG(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE)"
    ),
)
def lag_change(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", money("o_totalprice").alias("amount"))
    out = W.delta_prev(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], "amount", "prev_amount", "amount_change")
    return out.select(
        "o_orderkey", "o_custkey", F.col("prev_amount").cast("double"), F.col("amount_change").cast("double")
    )


@query(
    "running_total",
    "W4",
    """SELECT o_orderkey, o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey
    ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total FROM orders""",
)
def running_total(t):
    out = W.running_total(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], money("o_totalprice"), "running_total")
    return out.select("o_orderkey", "o_custkey", F.col("running_total").cast("double"))


@query(
    "ntile_quartiles",
    "W5",
    """WITH s AS (SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend FROM orders GROUP BY o_custkey)
    SELECT o_custkey, spend, CAST(NTILE(4) OVER (ORDER BY spend, o_custkey) AS INTEGER) AS spend_quartile FROM s""",
)
def ntile_quartiles(t):
    spend = t.orders.groupBy("o_custkey").agg(money_sum("o_totalprice").alias("spend"))
    return W.ntile_by(spend, ["spend", "o_custkey"], 4, "spend_quartile")


@query(
    "first_last_value",
    "W6",
    """SELECT o_orderkey, o_custkey, FIRST_VALUE(o_orderkey) OVER w AS first_o_orderkey, FIRST_VALUE(o_totalprice) OVER w AS first_o_totalprice,
    LAST_VALUE(o_orderkey) OVER w AS last_o_orderkey, LAST_VALUE(o_totalprice) OVER w AS last_o_totalprice
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def first_last_value(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    out = W.first_last(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_totalprice"])
    return out.drop("o_totalprice", "o_orderdate")


@query(
    "top_two_per_key",
    "W7",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 2""",
)
def top_two_per_key(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return W.top_n(rows, ["o_custkey"], ["-o_totalprice", "o_orderkey"], 2)


@query(
    "gap_sessions",
    "W8",
    """WITH p AS (SELECT *, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events)
    SELECT event_id, user_id, CAST(SUM(CASE WHEN b IS NULL OR ts - b > INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
      OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_id FROM p""",
)
def gap_sessions(t):
    out = W.sessionize(t.events, ["user_id"], "ts", 1800, ["ts", "event_id"], "session_id")
    return out.select("event_id", "user_id", "session_id")


@query(
    "rolling_seven_thirty",
    "W9",
    """WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, SUM(CAST(value AS DECIMAL(18,2))) AS v, COUNT(*) AS n FROM events GROUP BY ALL)
    SELECT event_type, day, CAST(SUM(v) OVER w7 AS DOUBLE) / COUNT(*) OVER w7 AS avg_7, CAST(SUM(n) OVER w30 AS BIGINT) AS events_30
    FROM d WINDOW w7 AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
      w30 AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
)
def rolling_seven_thirty(t):
    daily = t.events.groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(
        F.sum(money("value")).alias("v"), F.count(F.lit(1)).alias("n")
    )
    # one row per day and type: a group cannot outgrow a task
    out = W.rolling(daily, ["event_type"], ["day"], 7, {"s7": F.sum("v"), "c7": F.count("v")}, bounded=True)
    out = W.rolling(out, ["event_type"], ["day"], 30, {"events_30": F.sum("n")}, bounded=True)
    return out.select("event_type", "day", (F.col("s7").cast("double") / F.col("c7")).alias("avg_7"), "events_30")


@query(
    "share_of_group",
    "W10",
    """WITH p AS (SELECT p_brand, l_partkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
    SELECT p_brand, l_partkey, CAST(revenue AS DOUBLE) AS revenue,
      CAST(revenue AS DOUBLE) * 100 / CAST(SUM(revenue) OVER (PARTITION BY p_brand) AS DOUBLE) AS share_pct FROM p""",
)
def share_of_group(t):
    return W.share_of(_brand_revenue(t), ["p_brand"], F.col("revenue"), "share_pct").withColumn(
        "revenue", F.col("revenue").cast("double")
    )


def _brand_revenue(t):
    by_part = t.lineitem.groupBy("l_partkey").agg(F.sum(money("l_extendedprice")).alias("revenue"))
    return by_part.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_brand", "l_partkey", "revenue")


@query(
    "cumulative_share",
    "W11",
    """WITH p AS (SELECT p_brand, l_partkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
    SELECT p_brand, l_partkey, CAST(SUM(revenue) OVER (PARTITION BY p_brand ORDER BY revenue DESC, l_partkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) * 100
      / CAST(SUM(revenue) OVER (PARTITION BY p_brand) AS DOUBLE) AS cumulative_pct FROM p""",
)
def cumulative_share(t):
    out = W.cumulative_share(
        _brand_revenue(t), ["p_brand"], ["-revenue", "l_partkey"], F.col("revenue"), "cumulative_pct"
    )
    return out.drop("revenue")


@query(
    "rank_in_group",
    "W12",
    """WITH p AS (SELECT p_brand, l_partkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
    SELECT p_brand, l_partkey, RANK() OVER (PARTITION BY p_brand ORDER BY revenue DESC) AS revenue_rank,
      ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY revenue DESC, l_partkey) AS revenue_row FROM p""",
)
def rank_in_group(t):
    from ..operators.ordered import Ordered

    ranked = W.rank_by(_brand_revenue(t), ["-revenue"], ["p_brand"], rank="revenue_rank")
    return Ordered(ranked, ["p_brand"], ["-revenue", "l_partkey"]).row_number("revenue_row").result().drop("revenue")


@query(
    "qualify_filter",
    "W14",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders QUALIFY COUNT(*) OVER (PARTITION BY o_custkey, o_orderdate) > 1""",
)
def qualify_filter(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    counted = W.group_total(rows, ["o_custkey", "o_orderdate"], F.count(F.lit(1)), "w")
    return counted.where("w > 1").drop("w", "o_orderdate")


@query(
    "qualify_rank",
    "W14 W12",
    "SELECT l_partkey, l_orderkey, l_quantity FROM lineitem QUALIFY RANK() OVER (PARTITION BY l_partkey ORDER BY l_quantity DESC) <= 2",
)
def qualify_rank(t):
    rows = t.lineitem.select("l_partkey", "l_orderkey", "l_quantity")
    by = Window.partitionBy("l_partkey").orderBy(F.desc("l_quantity"))
    return W.qualify(rows, F.rank().over(by), "w <= 2")
