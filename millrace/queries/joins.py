"""Joins, set operations, sorting and limits on the driver tables."""

from pyspark.sql import functions as F

from ..functions.measures import money_avg, money_sum
from ..operators import joins as J
from ..operators.windows import rank_by
from .registry import Tables, query


def customers(t: Tables):
    """Customers with their region, in the role of the customer dimension."""
    nation = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("tier"),
        F.col("c_acctbal").alias("balance"),
    )


CUSTOMERS_SQL = """(SELECT c_custkey AS customer_id, c_name AS name, r_name AS region, c_mktsegment AS tier, c_acctbal AS balance
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


@query(
    "regional_monthly_rank",
    "J1 J11 A1 W12",
    f"""WITH m AS (
      SELECT c.region, date_trunc('month', o_orderdate)::DATE AS month, COUNT(*) AS orders,
             CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
      FROM orders JOIN {CUSTOMERS_SQL} c ON o_custkey = c.customer_id GROUP BY ALL)
    SELECT *, RANK() OVER (PARTITION BY month ORDER BY revenue DESC, region) AS revenue_rank FROM m""",
)
def regional_monthly_rank(t):
    monthly = (
        t.orders.join(customers(t), F.col("o_custkey") == F.col("customer_id"))
        .groupBy("region", F.trunc("o_orderdate", "month").alias("month"))
        .agg(F.count(F.lit(1)).alias("orders"), money_sum("o_totalprice").alias("revenue"))
    )
    # a month holds one row per region
    return rank_by(monthly, ["-revenue", "region"], ["month"], rank="revenue_rank", bounded=True)


@query(
    "join_inner",
    "J1 K1",
    f"""SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderdate, c.name, c.region, c.tier
    FROM orders JOIN {CUSTOMERS_SQL} c ON o_custkey = c.customer_id""",
)
def join_inner(t):
    return t.orders.join(customers(t), F.col("o_custkey") == F.col("customer_id")).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate", "name", "region", "tier"
    )


@query(
    "join_left_default",
    "J2 P9",
    """SELECT o_orderkey, o_custkey, COALESCE(c_name, 'Unknown') AS name, c_mktsegment AS tier
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey""",
)
def join_left_default(t):
    dim = t.customer.where("c_acctbal > 0").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("tier")
    )
    out = J.left_enrich(t.orders.select("o_orderkey", "o_custkey"), dim, "o_custkey", {"name": "Unknown"})
    return out.select("o_orderkey", "o_custkey", "name", "tier")


@query(
    "join_left_anti",
    "J3",
    "SELECT * FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')",
)
def join_left_anti(t):
    return J.orphans(t.lineitem, t.orders.where("o_orderstatus <> 'P'"), [("l_orderkey", "o_orderkey")])


@query(
    "join_left_semi",
    "J4",
    "SELECT * FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)",
)
def join_left_semi(t):
    return J.with_match(t.customer, t.orders.where("o_totalprice > 450000"), [("c_custkey", "o_custkey")])


@query(
    "join_linked_pairs",
    "J5",
    """SELECT * FROM (SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS month,
      LAG(o_orderkey) OVER w AS o_orderkey_1, o_orderkey AS o_orderkey_2,
      LAG(o_totalprice) OVER w AS o_totalprice_1, o_totalprice AS o_totalprice_2
      FROM orders WINDOW w AS (PARTITION BY o_custkey, date_trunc('month', o_orderdate) ORDER BY o_orderkey))
    WHERE o_orderkey_1 IS NOT NULL""",
)
def join_linked_pairs(t):
    orders = t.orders.withColumn("month", F.trunc("o_orderdate", "month"))
    return J.linked_pairs(orders, ["o_custkey", "month"], ["o_orderkey"], ["o_orderkey", "o_totalprice"])


@query(
    "join_group_members",
    "J5",
    """SELECT o_custkey, o_orderdate::DATE AS day, o_orderkey, o_totalprice, COUNT(*) OVER w AS group_size, ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderdate::DATE ORDER BY o_orderkey) AS position
    FROM orders WINDOW w AS (PARTITION BY o_custkey, o_orderdate::DATE) QUALIFY group_size > 1""",
)
def join_group_members(t):
    """Orders that a customer placed on one day with others."""
    orders = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderkey", "o_totalprice")
    return J.group_members(orders, ["o_custkey", "day"], ["o_orderkey"])


@query(
    "join_chain_best_line",
    "J6 W14",
    f"""SELECT o_orderkey, c.name AS customer_name, c.region, l_quantity, l_extendedprice, p_name, p_brand, o_orderstatus
    FROM orders JOIN {CUSTOMERS_SQL} c ON o_custkey = c.customer_id
    JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
    QUALIFY ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY l_quantity DESC, l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1""",
)
def join_chain_best_line(t):
    # lines without a part do not count, so parts join first; the other joins see one line per order
    best = J.best_line(
        t.lineitem.join(t.part.select("p_partkey", "p_name", "p_brand"), F.col("p_partkey") == F.col("l_partkey")),
        ["l_orderkey"],
        ["-l_quantity", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"],
    )
    return (
        t.orders.join(best, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(customers(t), F.col("o_custkey") == F.col("customer_id"))
        .select(
            "o_orderkey", F.col("name").alias("customer_name"), "region", "l_quantity",
            "l_extendedprice", "p_name", "p_brand", "o_orderstatus",
        )
    )


@query(
    "join_aggregate_first",
    "J7 A1 A2",
    f"""SELECT c.customer_id, c.name, c.region, a.order_count, a.total_spent, a.total_spent / a.order_count AS avg_order_value
    FROM (SELECT o_custkey, COUNT(*) AS order_count, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spent
          FROM orders GROUP BY o_custkey HAVING SUM(CAST(o_totalprice AS DECIMAL(18,2))) > 2500000) a
    JOIN {CUSTOMERS_SQL} c ON a.o_custkey = c.customer_id""",
)
def join_aggregate_first(t):
    spent = (
        t.orders.groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            money_sum("o_totalprice").alias("total_spent"),
            money_avg("o_totalprice").alias("avg_order_value"),
        )
        .where("total_spent > 2500000")
    )
    return spent.join(customers(t), F.col("o_custkey") == F.col("customer_id")).select(
        "customer_id", "name", "region", "order_count", "total_spent", "avg_order_value"
    )


@query(
    "join_broadcast_small",
    "J8",
    """SELECT n_name, COUNT(*) AS customers, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def join_broadcast_small(t):
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name")
        .agg(F.count(F.lit(1)).alias("customers"), money_sum("c_acctbal").alias("balance"))
    )


@query(
    "scalar_beside_scalar",
    "J9",
    """SELECT a.total_orders, a.revenue, b.total_lines, b.units FROM
      (SELECT COUNT(*) AS total_orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders) a,
      (SELECT COUNT(*) AS total_lines, CAST(SUM(l_quantity) AS DOUBLE) AS units FROM lineitem) b""",
)
def scalar_beside_scalar(t):
    orders = t.orders.agg(F.count(F.lit(1)).alias("total_orders"), money_sum("o_totalprice").alias("revenue"))
    lines = t.lineitem.agg(F.count(F.lit(1)).alias("total_lines"), F.sum("l_quantity").alias("units"))
    # side by side without a product: stack the one-row results, keep what is set in each column
    both = orders.unionByName(lines, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def two_states(t: Tables):
    """Orders before and after a change: old years dropped, a new year added, urgent prices raised."""
    before = t.orders.where("o_orderdate < timestamp_ntz'2001-01-01'")
    after = t.orders.where("o_orderdate >= timestamp_ntz'1996-01-01'").withColumn(
        "o_totalprice", F.expr("if(o_orderpriority = '1-URGENT', o_totalprice + 1, o_totalprice)")
    )
    return before, after


@query(
    "state_diff",
    "J10",
    """WITH a AS (SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'),
    b AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderstatus
          FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')
    SELECT COALESCE(a.o_orderkey, b.o_orderkey) AS o_orderkey,
      CASE WHEN a.o_orderkey IS NULL THEN 'added' WHEN b.o_orderkey IS NULL THEN 'removed'
           WHEN a.o_totalprice IS NOT DISTINCT FROM b.o_totalprice AND a.o_orderstatus IS NOT DISTINCT FROM b.o_orderstatus THEN 'same'
           ELSE 'changed' END AS state
    FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey""",
)
def state_diff(t):
    columns = ["o_orderkey", "o_totalprice", "o_orderstatus"]
    before, after = two_states(t)
    return J.diff_keys(before.select(*columns), after.select(*columns), ["o_orderkey"])


@query(
    "join_star",
    "J11",
    """SELECT r_name AS region, p_brand AS brand, o_orderpriority AS priority, COUNT(*) AS lines, CAST(SUM(l_quantity) AS DOUBLE) AS units
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY ALL""",
)
def join_star(t):
    nation = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    store = t.supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "r_name")
    facts = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    joined = J.star(
        facts,
        [
            (t.part.select("p_partkey", "p_brand"), "l_partkey", "p_partkey"),
            (store, "l_suppkey", "s_suppkey"),
            (t.orders.select("o_orderkey", "o_orderpriority"), "l_orderkey", "o_orderkey"),
        ],
    )
    return joined.groupBy(
        F.col("r_name").alias("region"), F.col("p_brand").alias("brand"), F.col("o_orderpriority").alias("priority")
    ).agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("units"))


@query(
    "join_not_in",
    "J12",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')",
)
def join_not_in(t):
    return J.orphans(
        t.customer.select("c_custkey", "c_name"), t.orders.where("o_orderstatus = 'F'"), [("c_custkey", "o_custkey")]
    )


# -- set operations -------------------------------------------------------


@query(
    "union_all",
    "U1",
    """SELECT c_nationkey AS nationkey, 'customer' AS kind, c_acctbal AS balance FROM customer
    UNION ALL SELECT s_nationkey, 'supplier', s_acctbal FROM supplier""",
)
def union_all(t):
    c = t.customer.select(F.col("c_nationkey").alias("nationkey"), F.lit("customer").alias("kind"), F.col("c_acctbal").alias("balance"))
    s = t.supplier.select(F.col("s_nationkey").alias("nationkey"), F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("balance"))
    return c.union(s)


@query(
    "union_distinct",
    "U2",
    "SELECT l_partkey AS partkey FROM lineitem UNION SELECT p_partkey FROM part",
)
def union_distinct(t):
    return t.lineitem.select(F.col("l_partkey").alias("partkey")).union(t.part.select("p_partkey")).distinct()


@query(
    "except_both_ways",
    "U3",
    """WITH a AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'),
    b AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
          FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')
    SELECT DISTINCT o_orderkey FROM ((SELECT * FROM a EXCEPT SELECT * FROM b) UNION (SELECT * FROM b EXCEPT SELECT * FROM a))""",
)
def except_both_ways(t):
    from ..operators.setops import changed_rows

    columns = ["o_orderkey", "o_totalprice"]
    before, after = two_states(t)
    return changed_rows(before.select(*columns), after.select(*columns)).select("o_orderkey").distinct()


@query(
    "intersect_rows",
    "U3",
    "SELECT c_nationkey AS nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier",
)
def intersect_rows(t):
    return t.customer.select(F.col("c_nationkey").alias("nationkey")).intersect(
        t.supplier.select("s_nationkey")
    )


@query(
    "union_by_name",
    "U4",
    """SELECT o_orderkey AS id, o_totalprice AS amount, o_orderpriority AS priority FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
    UNION ALL SELECT o_orderkey, o_totalprice, NULL FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""",
)
def union_by_name(t):
    old = t.orders.where("o_orderdate < timestamp_ntz'1998-01-01'").selectExpr(
        "o_orderpriority as priority", "o_orderkey as id", "o_totalprice as amount"
    )
    new = t.orders.where("o_orderdate >= timestamp_ntz'1998-01-01'").selectExpr("o_orderkey as id", "o_totalprice as amount")
    return new.unionByName(old, allowMissingColumns=True)


# -- sorting and limits ---------------------------------------------------


@query("order_by_global", "O1", "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def order_by_global(t):
    return t.customer.select("c_custkey", "c_name", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey")


@query(
    "top_k",
    "O2",
    """SELECT l_partkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM lineitem
    GROUP BY l_partkey ORDER BY revenue DESC, l_partkey LIMIT 10""",
)
def top_k(t):
    return (
        t.lineitem.groupBy("l_partkey").agg(money_sum("l_extendedprice").alias("revenue"))
        .orderBy(F.desc("revenue"), "l_partkey").limit(10)
    )


@query("sample_preview", "O3")
def sample_preview(t):
    return t.orders.sample(fraction=0.05, seed=42)


@query(
    "limit_parameter",
    "O4",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 7",
)
def limit_parameter(t):
    return t.spark.sql(
        "SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT :n",
        args={"n": 7},
        orders=t.orders,
    )
