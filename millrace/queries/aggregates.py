"""Grouping queries."""

from pyspark.sql import functions as F

from ..functions.measures import count_when, money, money_avg, money_sum
from ..operators import aggregates as A
from ..operators import joins as J
from .joins import CUSTOMERS_SQL, customers
from .registry import query

MONEY = "CAST(SUM(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)".format


def order_facts(t):
    return t.orders.join(customers(t), F.col("o_custkey") == F.col("customer_id"))


FACTS_SQL = f"orders JOIN {CUSTOMERS_SQL} c ON o_custkey = c.customer_id"


@query(
    "agg_group",
    "A1",
    f"""SELECT o_orderstatus, o_orderpriority, COUNT(*) AS orders, {MONEY('o_totalprice')} AS revenue,
    {MONEY('o_totalprice')} / COUNT(o_totalprice) AS avg_value FROM orders GROUP BY ALL""",
)
def agg_group(t):
    return t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"),
        money_sum("o_totalprice").alias("revenue"),
        money_avg("o_totalprice").alias("avg_value"),
    )


@query(
    "agg_having",
    "A2",
    f"SELECT o_custkey, COUNT(*) AS orders, {MONEY('o_totalprice')} AS spent FROM orders GROUP BY o_custkey HAVING COUNT(*) > 12",
)
def agg_having(t):
    return (
        t.orders.groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("orders"), money_sum("o_totalprice").alias("spent"))
        .where("orders > 12")
    )


@query(
    "agg_rollup",
    "A3",
    f"""SELECT region, tier, GROUPING_ID(region, tier) AS level, COUNT(*) AS orders, {MONEY('o_totalprice')} AS revenue,
    {MONEY('o_totalprice')} / COUNT(o_totalprice) AS avg_value
    FROM {FACTS_SQL} WHERE o_orderstatus = 'F' GROUP BY ROLLUP(region, tier)""",
)
def agg_rollup(t):
    return (
        order_facts(t).where("o_orderstatus = 'F'")
        .rollup("region", "tier")
        .agg(
            F.grouping_id().alias("level"),
            F.count(F.lit(1)).alias("orders"),
            money_sum("o_totalprice").alias("revenue"),
            money_avg("o_totalprice").alias("avg_value"),
        )
    )


@query(
    "agg_rollup_having",
    "A3 A2",
    f"""SELECT region, tier, GROUPING_ID(region, tier) AS level, COUNT(*) AS orders
    FROM {FACTS_SQL} WHERE o_orderstatus = 'F' GROUP BY ROLLUP(region, tier) HAVING COUNT(*) > 200""",
)
def agg_rollup_having(t):
    return (
        order_facts(t).where("o_orderstatus = 'F'")
        .rollup("region", "tier")
        .agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("orders"))
        .where("orders > 200")
    )


@query(
    "agg_cube",
    "A4",
    f"""SELECT region, o_orderstatus, GROUPING_ID(region, o_orderstatus) AS level, COUNT(*) AS orders, {MONEY('o_totalprice')} AS revenue
    FROM {FACTS_SQL} GROUP BY CUBE(region, o_orderstatus)""",
)
def agg_cube(t):
    return (
        order_facts(t).cube("region", "o_orderstatus")
        .agg(
            F.grouping_id().alias("level"),
            F.count(F.lit(1)).alias("orders"),
            money_sum("o_totalprice").alias("revenue"),
        )
    )


@query(
    "agg_conditional",
    "A5",
    """SELECT user_id, COUNT(CASE WHEN event_type = 'view' THEN 1 END) AS views,
    COUNT(CASE WHEN event_type = 'purchase' THEN 1 END) AS purchases,
    CAST(SUM(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS spent
    FROM events GROUP BY user_id""",
)
def agg_conditional(t):
    bought = F.col("event_type") == "purchase"
    return t.events.groupBy("user_id").agg(
        count_when(F.col("event_type") == "view").alias("views"),
        count_when(bought).alias("purchases"),
        F.sum(F.when(bought, money("value")).otherwise(0)).cast("double").alias("spent"),
    )


@query(
    "agg_count_distinct",
    "A6",
    """SELECT l_returnflag, COUNT(DISTINCT l_orderkey) AS orders, COUNT(DISTINCT l_partkey) AS parts
    FROM lineitem GROUP BY l_returnflag""",
)
def agg_count_distinct(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey").alias("parts")
    )


@query(
    "agg_approx_distinct",
    "A7",
    "SELECT l_returnflag, COUNT(DISTINCT l_orderkey) AS orders, TRUE AS estimate_is_close FROM lineitem GROUP BY l_returnflag",
)
def agg_approx_distinct(t):
    """The estimate may be off by its standard error of 5 %; three times that counts as close."""
    counts = t.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders"), F.approx_count_distinct("l_orderkey", 0.05).alias("estimate")
    )
    close = F.abs(F.col("estimate") - F.col("orders")) <= F.col("orders") * 0.15
    return counts.select("l_returnflag", "orders", close.alias("estimate_is_close"))


@query(
    "agg_min_max_first",
    "A8",
    """SELECT o_custkey, MIN(o_orderdate) AS first_order, MAX(o_orderdate) AS last_order,
    arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_key FROM orders GROUP BY o_custkey""",
)
def agg_min_max_first(t):
    return t.orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
        F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("first_key"),
    )


@query(
    "agg_collect",
    "A9",
    """SELECT o_custkey, 0 AS chunk, string_agg(o_orderkey, ',' ORDER BY o_orderdate, o_orderkey) AS order_keys,
    array_to_string(list_sort(list_distinct(list(o_orderpriority))), ',') AS priorities FROM orders GROUP BY o_custkey""",
)
def agg_collect(t):
    lists = A.collect_chunks(
        t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("o_orderkey"), "order_keys"
    )
    # a set is bounded by the distinct priorities, not by the orders
    sets = t.orders.groupBy("o_custkey").agg(F.sort_array(F.collect_set("o_orderpriority")).alias("priorities"))
    return lists.join(sets, "o_custkey").select(
        "o_custkey",
        "chunk",
        F.concat_ws(",", F.col("order_keys").cast("array<string>")).alias("order_keys"),
        F.concat_ws(",", "priorities").alias("priorities"),
    )


STATUS = ["F", "O", "P"]


@query(
    "agg_pivot",
    "A10 P10",
    """SELECT o_custkey, COUNT(*) FILTER (o_orderstatus = 'F') AS "F", COUNT(*) FILTER (o_orderstatus = 'O') AS "O",
    COUNT(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY o_custkey""",
)
def agg_pivot(t):
    return A.pivot_counts(t.orders, ["o_custkey"], "o_orderstatus", STATUS)


@query(
    "agg_unpivot",
    "A11",
    "SELECT o_custkey, o_orderstatus AS status, COUNT(*) AS orders FROM orders GROUP BY ALL",
)
def agg_unpivot(t):
    wide = A.pivot_counts(t.orders, ["o_custkey"], "o_orderstatus", STATUS)
    return A.unpivot(wide, ["o_custkey"], STATUS, "status", "orders")


@query(
    "agg_salted",
    "A12",
    """SELECT event_type, CAST(ts AS DATE) AS day, COUNT(*) AS events, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY ALL""",
)
def agg_salted(t):
    days = t.events.withColumn("day", F.col("ts").cast("date"))
    out = A.salted_agg(
        days, ["event_type", "day"],
        {"n": F.count(F.lit(1)), "v": F.sum(money("value"))},
        {"events": F.sum("n"), "total": F.sum("v").cast("double")},
        ["event_id"],
    )
    return out


@query(
    "agg_time_bucket",
    "A13",
    """SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS bucket, event_type, COUNT(*) AS events,
    COUNT(DISTINCT user_id) AS users FROM events GROUP BY ALL""",
)
def agg_time_bucket(t):
    return (
        t.events.groupBy(F.window("ts", "6 hours"), "event_type")
        .agg(F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("users"))
        .select(F.col("window.start").alias("bucket"), "event_type", "events", "users")
    )


@query(
    "agg_ratio",
    "A14",
    f"""SELECT o_custkey, {MONEY("CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END")}
      / NULLIF({MONEY("CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0 END")}, 0) AS done_to_open FROM orders GROUP BY o_custkey""",
)
def agg_ratio(t):
    def part(status):
        return money_sum(F.when(F.col("o_orderstatus") == status, F.col("o_totalprice")).otherwise(0))

    return t.orders.groupBy("o_custkey").agg(F.try_divide(part("F"), part("O")).alias("done_to_open"))


@query("agg_distinct", "A15", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def agg_distinct(t):
    return t.lineitem.select("l_orderkey", "l_linenumber").distinct()


@query(
    "agg_profile",
    "A16",
    """SELECT COUNT(*) AS total_records, COUNT(c_acctbal) AS non_null_balances, COUNT(DISTINCT c_custkey) AS unique_ids,
    COUNT(CASE WHEN c_acctbal < 0 THEN 1 END) AS negative_balances, COUNT(CASE WHEN c_mktsegment = '' THEN 1 END) AS empty_segments
    FROM customer""",
)
def agg_profile(t):
    return t.customer.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count("c_acctbal").alias("non_null_balances"),
        F.count_distinct("c_custkey").alias("unique_ids"),
        count_when(F.col("c_acctbal") < 0).alias("negative_balances"),
        count_when(F.col("c_mktsegment") == "").alias("empty_segments"),
    )


@query(
    "agg_health_report",
    "A19",
    """SELECT 'customer' AS name, COUNT(*) AS rows FROM customer UNION ALL SELECT 'orders', COUNT(*) FROM orders
    UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem
    UNION ALL SELECT 'lineitem without order', COUNT(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'customer without order', COUNT(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""",
)
def agg_health_report(t):
    return A.count_report(
        [
            ("customer", t.customer),
            ("orders", t.orders),
            ("lineitem", t.lineitem),
            ("lineitem without order", J.orphans(t.lineitem, t.orders, [("l_orderkey", "o_orderkey")])),
            ("customer without order", J.orphans(t.customer, t.orders, [("c_custkey", "o_custkey")])),
        ]
    )
