"""Merge, versioned dimensions, change feeds, constraints and conditional writes."""

from pyspark.sql import functions as F

from ..operators import changes as C
from ..operators import merge as M
from ..operators import quality as Q
from ..operators import scd as S
from ..operators.windows import top_n
from ..session import pin, work_dir
from ..sources import guarded as G
from ..sources.versioned import VersionedTable
from .joins import CUSTOMERS_SQL, customers
from .registry import query

# The target holds the orders before 1999.  The batch holds those since 1998:
# 1998 overlaps.  In the batch urgent orders cost 100 more and are newer, high
# ones are stale, low ones are set to P.
TARGET_SQL = """(SELECT o_orderkey, o_custkey, o_totalprice AS amount, o_orderstatus AS status, o_orderdate AS updated_at
  FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')"""
BATCH_SQL = """(SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 100 ELSE o_totalprice END AS amount,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'P' ELSE o_orderstatus END AS status,
  CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate + INTERVAL 1 DAY WHEN o_orderpriority = '2-HIGH' THEN o_orderdate - INTERVAL 1 DAY
       ELSE o_orderdate END AS updated_at, o_orderpriority AS priority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')"""
BOTH_SQL = f"{TARGET_SQL} t FULL JOIN {BATCH_SQL} s ON t.o_orderkey = s.o_orderkey"
COLUMNS = ["o_orderkey", "o_custkey", "amount", "status", "updated_at"]


def target(t):
    return t.orders.where("o_orderdate < timestamp_ntz'1999-01-01'").selectExpr(
        "o_orderkey", "o_custkey", "o_totalprice as amount", "o_orderstatus as status", "o_orderdate as updated_at"
    )


def batch(t):
    return t.orders.where("o_orderdate >= timestamp_ntz'1998-01-01'").selectExpr(
        "o_orderkey",
        "o_custkey",
        "if(o_orderpriority = '1-URGENT', o_totalprice + 100, o_totalprice) as amount",
        "if(o_orderpriority = '5-LOW', 'P', o_orderstatus) as status",
        """case o_orderpriority when '1-URGENT' then o_orderdate + interval 1 day
           when '2-HIGH' then o_orderdate - interval 1 day else o_orderdate end as updated_at""",
        "o_orderpriority as priority",
    )


def _picked(expression: str, where: str = "TRUE") -> str:
    """SELECT of every target column, ``{c}`` in the expression standing for its name."""
    parts = ", ".join(f"{expression.format(c=c)} AS {c}" for c in COLUMNS)
    return f"SELECT {parts} FROM {BOTH_SQL} WHERE {where}"


@query("merge_upsert", "M1 M14", _picked("CASE WHEN s.o_orderkey IS NOT NULL THEN s.{c} ELSE t.{c} END"))
def merge_upsert(t):
    return M.merge(target(t), batch(t), ["o_orderkey"], keyed=True, check=False)


@query("merge_insert_only", "M2", _picked("CASE WHEN t.o_orderkey IS NOT NULL THEN t.{c} ELSE s.{c} END"))
def merge_insert_only(t):
    return M.merge(target(t), batch(t), ["o_orderkey"], [M.insert()])


@query(
    "merge_update_only",
    "M3",
    _picked("CASE WHEN s.o_orderkey IS NOT NULL THEN s.{c} ELSE t.{c} END", "t.o_orderkey IS NOT NULL"),
)
def merge_update_only(t):
    return M.merge(target(t), batch(t), ["o_orderkey"], [M.update()])


@query(
    "merge_latest_per_customer",
    "M4 W1",
    f"""WITH s AS (SELECT * FROM {BATCH_SQL} QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY updated_at DESC, o_orderkey) = 1),
    t AS (SELECT c_custkey AS o_custkey, c_acctbal AS amount, 'none' AS status FROM customer)
    SELECT COALESCE(t.o_custkey, s.o_custkey) AS o_custkey, CASE WHEN s.o_custkey IS NOT NULL THEN s.amount ELSE t.amount END AS amount,
      CASE WHEN s.o_custkey IS NOT NULL THEN s.status ELSE t.status END AS status
    FROM t FULL JOIN s ON t.o_custkey = s.o_custkey""",
)
def merge_latest_per_customer(t):
    accounts = t.customer.selectExpr("c_custkey as o_custkey", "c_acctbal as amount", "'none' as status")
    return M.merge(accounts, batch(t), ["o_custkey"], dedupe=["-updated_at", "o_orderkey"], keyed=True)


@query(
    "merge_newer_wins",
    "M5",
    _picked("CASE WHEN t.o_orderkey IS NULL OR s.updated_at > t.updated_at THEN s.{c} ELSE t.{c} END"),
)
def merge_newer_wins(t):
    clauses = [M.update(when="s.updated_at > t.updated_at"), M.insert()]
    return M.merge(target(t), batch(t), ["o_orderkey"], clauses, keyed=True, check=False)


@query(
    "merge_delete_clause",
    "M6",
    _picked(
        "CASE WHEN s.o_orderkey IS NOT NULL THEN s.{c} ELSE t.{c} END",
        "NOT (t.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL AND s.status = 'P')",
    ),
)
def merge_delete_clause(t):
    clauses = [M.delete("s.status = 'P'"), M.update(), M.insert()]
    return M.merge(target(t), batch(t), ["o_orderkey"], clauses, keyed=True, check=False)


@query(
    "merge_delete_update_insert",
    "M7",
    _picked(
        "CASE WHEN t.o_orderkey IS NULL OR s.updated_at > t.updated_at THEN s.{c} ELSE t.{c} END",
        "NOT (t.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL AND s.status = 'P') AND NOT (t.o_orderkey IS NULL AND s.status = 'P')",
    ),
)
def merge_delete_update_insert(t):
    clauses = [M.delete("s.status = 'P'"), M.update(when="s.updated_at > t.updated_at"), M.insert(when="s.status <> 'P'")]
    # not declared as keyed: the left join and anti join path
    return M.merge(target(t), batch(t), ["o_orderkey"], clauses)


@query(
    "merge_explicit_columns",
    "M8",
    f"""SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey, COALESCE(t.o_custkey, s.o_custkey) AS o_custkey,
      CASE WHEN t.o_orderkey IS NULL THEN s.amount WHEN s.o_orderkey IS NOT NULL THEN t.amount + s.amount ELSE t.amount END AS amount,
      CASE WHEN t.o_orderkey IS NULL THEN 'new' WHEN s.o_orderkey IS NOT NULL THEN s.status ELSE t.status END AS status,
      CASE WHEN t.o_orderkey IS NULL THEN NULL ELSE t.updated_at END AS updated_at FROM {BOTH_SQL}""",
)
def merge_explicit_columns(t):
    clauses = [
        M.update(set={"amount": "t.amount + s.amount", "status": "s.status"}),
        M.insert(values={"o_orderkey": "s.o_orderkey", "o_custkey": "s.o_custkey", "amount": "s.amount", "status": "'new'"}),
    ]
    return M.merge(target(t), batch(t), ["o_orderkey"], clauses, keyed=True, check=False)


@query(
    "merge_evolve_schema",
    "M9",
    _picked("CASE WHEN s.o_orderkey IS NOT NULL THEN s.{c} ELSE t.{c} END").replace(
        "SELECT ", "SELECT s.priority AS priority, ", 1
    ),
)
def merge_evolve_schema(t):
    return M.merge(target(t), batch(t), ["o_orderkey"], evolve=True, keyed=True, check=False)


@query(
    "merge_valid_source",
    "M10 Q4",
    f"""WITH v AS (SELECT * FROM {BATCH_SQL} WHERE amount > 5000 AND status IS NOT NULL AND status <> 'P')
    SELECT {", ".join(f"CASE WHEN s.o_orderkey IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in COLUMNS)}
    FROM {TARGET_SQL} t FULL JOIN v s ON t.o_orderkey = s.o_orderkey""",
)
def merge_valid_source(t):
    rules = [Q.Constraint.not_null("status"), Q.Constraint.check("open", "status <> 'P'"), Q.Constraint.check("real", "amount > 5000")]
    valid, _ = Q.split_valid(batch(t), rules)
    return M.merge(target(t), valid, ["o_orderkey"], keyed=True, check=False)


def _daily(df):
    return df.groupBy("day", "region").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("revenue"),
    )


@query(
    "merge_refresh_aggregate",
    "M11 A18",
    f"""WITH f AS (SELECT CAST(o_orderdate AS DATE) AS day, region, o_totalprice, o_orderdate, o_orderstatus FROM orders JOIN {CUSTOMERS_SQL} c ON o_custkey = c.customer_id),
    g AS (SELECT day, region, COUNT(*) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM f WHERE o_orderdate < TIMESTAMP '1999-01-01' GROUP BY ALL),
    n AS (SELECT day, region, COUNT(*) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM f WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderstatus <> 'P' GROUP BY ALL)
    SELECT COALESCE(n.day, g.day) AS day, COALESCE(n.region, g.region) AS region, COALESCE(n.orders, g.orders) AS orders, COALESCE(n.revenue, g.revenue) AS revenue
    FROM g FULL JOIN n ON g.day = n.day AND g.region = n.region""",
)
def merge_refresh_aggregate(t):
    facts = t.orders.join(customers(t), F.col("o_custkey") == F.col("customer_id")).withColumn("day", F.to_date("o_orderdate"))
    gold = _daily(facts.where("o_orderdate < timestamp_ntz'1999-01-01'"))
    new = _daily(facts.where("o_orderdate >= timestamp_ntz'1998-01-01' and o_orderstatus <> 'P'"))
    return M.merge(gold, new, ["day", "region"], keyed=True, check=False)


# -- slowly changing dimensions ------------------------------------------

DIM = ["customer_id", "name", "region", "tier"]
NEW_SQL = f"""(SELECT customer_id, name, region, CASE WHEN tier = 'BUILDING' THEN 'MACHINERY' ELSE tier END AS tier FROM {CUSTOMERS_SQL} c
  WHERE balance > 0 UNION ALL SELECT -1 - s_suppkey, s_name, NULL, 'SUPPLIER' FROM supplier)"""


def dimension(t):
    start = F.lit("2023-01-01").cast("date")
    return S.scd2_init(customers(t).select(*DIM), start)


def dimension_update(t):
    moved = customers(t).where("balance > 0").select(
        "customer_id", "name", "region", F.expr("if(tier = 'BUILDING', 'MACHINERY', tier)").alias("tier")
    )
    new = t.supplier.selectExpr("-1 - s_suppkey as customer_id", "s_name as name", "cast(null as string) as region", "'SUPPLIER' as tier")
    return moved.unionByName(new)


def dimension_after(t):
    return S.scd2(dimension(t), dimension_update(t), ["customer_id"], ["name", "region", "tier"], F.lit("2024-06-01"))


SCD2_SQL = f"""(WITH d AS (SELECT customer_id, name, region, tier FROM {CUSTOMERS_SQL} c), s AS (SELECT * FROM {NEW_SQL} x),
    p AS (SELECT d.*, s.customer_id AS sid, s.name AS sname, s.region AS sregion, s.tier AS stier,
          s.customer_id IS NOT NULL AND (d.name IS DISTINCT FROM s.name OR d.region IS DISTINCT FROM s.region OR d.tier IS DISTINCT FROM s.tier) AS moved
          FROM d LEFT JOIN s ON d.customer_id = s.customer_id)
    SELECT customer_id, name, region, tier, NOT moved AS is_current, DATE '2023-01-01' AS effective_start_date,
      CASE WHEN moved THEN DATE '2024-06-01' ELSE DATE '9999-12-31' END AS effective_end_date, 1 AS version FROM p
    UNION ALL SELECT customer_id, sname, sregion, stier, TRUE, DATE '2024-06-01', DATE '9999-12-31', 2 FROM p WHERE moved
    UNION ALL SELECT customer_id, name, region, tier, TRUE, DATE '2024-06-01', DATE '9999-12-31', 1 FROM s
      WHERE customer_id NOT IN (SELECT customer_id FROM d))"""


@query(
    "scd2_initial",
    "M16",
    f"""SELECT customer_id, name, region, tier, TRUE AS is_current, DATE '2023-01-01' AS effective_start_date,
    DATE '9999-12-31' AS effective_end_date, 1 AS version FROM {CUSTOMERS_SQL} c""",
)
def scd2_initial(t):
    return dimension(t)


@query("scd2_apply", "M12 J15", f"SELECT * FROM {SCD2_SQL}")
def scd2_apply(t):
    return dimension_after(t)


@query("scd2_apply_again", "M12", f"SELECT * FROM {SCD2_SQL}")
def scd2_apply_again(t):
    once = pin(dimension_after(t), "dimension")
    return S.scd2(once, dimension_update(t), ["customer_id"], ["name", "region", "tier"], F.lit("2025-01-01"))


@query("scd2_current", "M15", f"SELECT customer_id, name, region, tier FROM {SCD2_SQL} WHERE is_current")
def scd2_current(t):
    return S.current(dimension_after(t)).select(*DIM)


@query(
    "scd2_version_counts",
    "M17",
    f"SELECT customer_id, COUNT(*) AS version_count FROM {SCD2_SQL} GROUP BY customer_id HAVING COUNT(*) > 1",
)
def scd2_version_counts(t):
    return S.version_counts(dimension_after(t), ["customer_id"])


# Orders read as a feed of customer changes: status is tracked, priority may be
# missing and is carried forward, the price is excluded.
CHANGES_SQL = """(SELECT o_custkey, o_orderkey AS seq, o_orderstatus AS status,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END AS priority FROM orders)"""


def customer_changes(t):
    return t.orders.selectExpr(
        "o_custkey", "o_orderkey as seq", "o_orderstatus as status",
        "nullif(o_orderpriority, '4-NOT SPECIFIED') as priority", "o_totalprice as price",
    )


@query(
    "apply_changes_history",
    "M13",
    f"""WITH f AS (SELECT o_custkey, seq, status, LAST_VALUE(priority IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY seq ROWS UNBOUNDED PRECEDING) AS priority,
        LAG(status) OVER (PARTITION BY o_custkey ORDER BY seq) AS p FROM {CHANGES_SQL}),
    v AS (SELECT *, SUM(CASE WHEN p IS NULL OR p <> status THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY seq ROWS UNBOUNDED PRECEDING) AS n FROM f),
    g AS (SELECT o_custkey, n, arg_max(status, seq) AS status, last(priority ORDER BY seq) AS priority, MIN(seq) AS start FROM v GROUP BY ALL)
    SELECT o_custkey, status, priority, start AS "__START_AT", LEAD(start) OVER (PARTITION BY o_custkey ORDER BY n) AS "__END_AT" FROM g""",
)
def apply_changes_history(t):
    return S.apply_changes(
        customer_changes(t), ["o_custkey"], "seq", track=["status"], ignore_nulls=True, exclude=["price"]
    )


@query(
    "apply_changes_latest",
    "M14",
    f"""SELECT o_custkey, arg_max(status, seq) AS status, arg_max(priority, seq) FILTER (priority IS NOT NULL) AS priority, MAX(seq) AS seq
    FROM {CHANGES_SQL} GROUP BY o_custkey""",
)
def apply_changes_latest(t):
    return S.apply_changes(customer_changes(t), ["o_custkey"], "seq", scd=1, ignore_nulls=True, exclude=["price"])


# -- change feeds and versions -------------------------------------------

# Commits: 0 inserts the orders before 1999, 1 the later ones, 2 raises urgent
# prices, 3 deletes the P orders before 1997.
LOG_SQL = """(WITH o AS (SELECT o_orderkey, o_custkey, o_totalprice AS amount, o_orderstatus AS status, o_orderdate, o_orderpriority AS priority FROM orders)
  SELECT o_orderkey, o_custkey, amount, status, 'insert' AS _change_type, CAST(0 AS BIGINT) AS _commit_version, TIMESTAMP '2024-01-01' AS _commit_timestamp FROM o WHERE o_orderdate < TIMESTAMP '1999-01-01'
  UNION ALL SELECT o_orderkey, o_custkey, amount, status, 'insert', 1, TIMESTAMP '2024-01-02' FROM o WHERE o_orderdate >= TIMESTAMP '1999-01-01'
  UNION ALL SELECT o_orderkey, o_custkey, amount, status, 'update_preimage', 2, TIMESTAMP '2024-01-03' FROM o WHERE priority = '1-URGENT'
  UNION ALL SELECT o_orderkey, o_custkey, amount + 100, status, 'update_postimage', 2, TIMESTAMP '2024-01-03' FROM o WHERE priority = '1-URGENT'
  UNION ALL SELECT o_orderkey, o_custkey, CASE WHEN priority = '1-URGENT' THEN amount + 100 ELSE amount END, status, 'delete', 3, TIMESTAMP '2024-01-04'
    FROM o WHERE status = 'P' AND o_orderdate < TIMESTAMP '1997-01-01')"""
STATE_SQL = """(SELECT * FROM {log} WHERE _change_type <> 'update_preimage' AND _commit_version <= {v}
  QUALIFY ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY _commit_version DESC) = 1)""".replace("{log}", LOG_SQL)
KEY = ["o_orderkey"]


def state_sql(v):
    return f"(SELECT o_orderkey, o_custkey, amount, status FROM {STATE_SQL.format(v=v)} WHERE _change_type <> 'delete')"


def day(n):
    return F.lit(f"2024-01-0{n}").cast("timestamp")


def change_log(t):
    """The log of the four commits, written out as a table of its own."""
    o = t.orders.selectExpr(
        "o_orderkey", "o_custkey", "o_totalprice as amount", "o_orderstatus as status", "o_orderdate", "o_orderpriority"
    )
    image = ["o_orderkey", "o_custkey", "amount", "status"]
    v0 = C.baseline(o.where("o_orderdate < timestamp_ntz'1999-01-01'").select(*image), 0, day(1))
    v1 = C.baseline(o.where("o_orderdate >= timestamp_ntz'1999-01-01'").select(*image), 1, day(2))
    now = o.select(*image)
    raised = o.where("o_orderpriority = '1-URGENT'").select(
        "o_orderkey", "o_custkey", (F.col("amount") + 100).alias("amount"), "status"
    )
    now, v2 = C.commit(now, raised, KEY, 2, day(3), [M.update()], check=False)
    gone = o.where("status = 'P' and o_orderdate < timestamp_ntz'1997-01-01'").select("o_orderkey")
    _, v3 = C.commit(now, gone, KEY, 3, day(4), [M.delete()], check=False)
    return pin(v0.unionByName(v1).unionByName(v2).unionByName(v3), "log")


def stored(t, every=2):
    """The same four commits as a table of its own, with a snapshot every two versions."""
    log = change_log(t)
    table = VersionedTable.create(C.as_of(C.changes(log, 0, 0), KEY), work_dir(t.spark, "versioned"), KEY, day(1), every)
    for version in (1, 2, 3):
        table.append_feed(C.changes(log, version, version))
    return table


def naive(df):
    return df.withColumn("_commit_timestamp", F.col("_commit_timestamp").cast("timestamp_ntz"))


@query("feed_of_commits", "D1 D2", f"SELECT * FROM {LOG_SQL}")
def feed_of_commits(t):
    return naive(change_log(t))


@query("feed_range", "S17", f"SELECT * FROM {LOG_SQL} WHERE _commit_version BETWEEN 1 AND 2 AND _change_type IN ('insert', 'update_postimage')")
def feed_range(t):
    return naive(C.changes(change_log(t), 1, 2, ["insert", "update_postimage"]))


@query("feed_diff_of_states", "D1", f"""SELECT * FROM (
    SELECT COALESCE(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN k = 'pre' THEN b.o_custkey ELSE a.o_custkey END AS o_custkey,
      CASE WHEN k = 'pre' THEN b.amount ELSE a.amount END AS amount, CASE WHEN k = 'pre' THEN b.status ELSE a.status END AS status,
      CASE WHEN b.o_orderkey IS NULL AND k = 'post' THEN 'insert' WHEN a.o_orderkey IS NULL AND k = 'pre' THEN 'delete'
           WHEN a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL AND (a.amount <> b.amount OR a.status <> b.status) THEN 'update_' || k || 'image' END AS _change_type,
      CAST(9 AS BIGINT) AS _commit_version, TIMESTAMP '2024-01-09' AS _commit_timestamp
    FROM {state_sql(0)} b FULL JOIN {state_sql(3)} a ON a.o_orderkey = b.o_orderkey, (VALUES ('pre'), ('post')) x(k)) WHERE _change_type IS NOT NULL""")
def feed_diff_of_states(t):
    log = change_log(t)
    return naive(C.diff(C.as_of(log, KEY, version=0), C.as_of(log, KEY, version=3), KEY, 9, day(9)))


@query("feed_apply", "D3", f"SELECT * FROM {state_sql(3)}")
def feed_apply(t):
    table = stored(t)
    return table.apply_to(table.state(0), since=0)


@query("state_at_version", "V-1", f"SELECT * FROM {state_sql(2)}")
def state_at_version(t):
    """A snapshot of version 0 and the two commits after it."""
    return stored(t, every=10).state(2)


@query("state_at_time", "V-2", f"SELECT * FROM {state_sql(1)}")
def state_at_time(t):
    return stored(t).state(timestamp="2024-01-02 12:00:00")


@query("commit_history", "V-3", f"""SELECT _commit_version, MAX(_commit_timestamp) AS _commit_timestamp,
    COUNT(*) FILTER (_change_type = 'insert') AS inserted, COUNT(*) FILTER (_change_type = 'update_postimage') AS updated,
    COUNT(*) FILTER (_change_type = 'delete') AS deleted,
    CASE _commit_version WHEN 2 THEN 'UPDATE' WHEN 3 THEN 'DELETE' ELSE 'INSERT' END AS operation FROM {LOG_SQL} GROUP BY _commit_version""")
def commit_history(t):
    return naive(stored(t).history())


@query("restore_version", "V-4", f"SELECT * FROM {state_sql(1)}")
def restore_version(t):
    table = stored(t)
    table.restore(1, day(5))
    return table.state()


@query("versions_changed_keys", "V-5", f"""SELECT DISTINCT o_orderkey FROM ((SELECT * FROM {state_sql(1)} EXCEPT SELECT * FROM {state_sql(3)})
    UNION (SELECT * FROM {state_sql(3)} EXCEPT SELECT * FROM {state_sql(1)}))""")
def versions_changed_keys(t):
    return stored(t).changed_keys(1, 3)


@query("audit_first_seen", "V-6", f"""SELECT o_orderkey, MIN(_commit_version) AS first_version FROM {LOG_SQL}
    WHERE _change_type IN ('insert', 'update_postimage') AND amount > 490000 GROUP BY o_orderkey""")
def audit_first_seen(t):
    return C.first_seen(stored(t).log(), KEY, "amount > 490000")


@query("undo_selected_rows", "V-7", f"""SELECT n.o_orderkey, n.o_custkey, CASE WHEN n.status = 'F' AND n.amount < 100000 AND o.o_orderkey IS NOT NULL THEN o.amount ELSE n.amount END AS amount, n.status
    FROM {state_sql(3)} n LEFT JOIN {state_sql(0)} o ON n.o_orderkey = o.o_orderkey""")
def undo_selected_rows(t):
    return stored(t).undo_where(0, "t.status = 'F' and t.amount < 100000")


@query("report_at_version", "V-8", f"""SELECT status, COUNT(*) AS orders, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
    FROM {state_sql(1)} GROUP BY status""")
def report_at_version(t):
    return stored(t).state(1).groupBy("status").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("total_amount")
    )


@query("expire_history", "V-9", f"""SELECT o_orderkey, o_custkey, amount, status, 'insert' AS _change_type, CAST(2 AS BIGINT) AS _commit_version,
    TIMESTAMP '2024-01-03' AS _commit_timestamp FROM {state_sql(2)} UNION ALL SELECT * FROM {LOG_SQL} WHERE _commit_version > 2""")
def expire_history(t):
    table = stored(t, every=3)
    table.expire(2)
    return naive(table.log())


LINES_SQL = "(SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_quantity) = 1)"


@query("versioned_merges", "V-1 M1 D2", f"""SELECT 0 AS version, l_returnflag, COUNT(*) AS lines, CAST(SUM(l_quantity) AS DOUBLE) AS quantity FROM {LINES_SQL} WHERE l_returnflag <> 'A' GROUP BY ALL
    UNION ALL SELECT 3, l_returnflag, COUNT(*), CAST(SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity + 100 ELSE l_quantity END) AS DOUBLE)
    FROM {LINES_SQL} WHERE NOT (l_returnflag = 'N' AND l_quantity > 25) GROUP BY ALL""")
def versioned_merges(t):
    """Three merges into a table of all order lines; the first state and the newest, both from snapshots."""
    keys = ["l_orderkey", "l_linenumber"]
    rows = pin(top_n(t.lineitem, keys, ["l_partkey", "l_quantity"], 1).select(*keys, "l_returnflag", "l_quantity"), "lines")
    table = VersionedTable.create(rows.where("l_returnflag <> 'A'"), work_dir(t.spark, "lines"), keys, day(1), every=2)
    table.merge(rows.where("l_returnflag = 'A'"), day(2), [M.insert()])
    table.merge(rows.where("l_returnflag = 'R'"), day(3), [M.update({"l_quantity": "t.l_quantity + 100"})])
    table.merge(rows.where("l_returnflag = 'N' and l_quantity > 25"), day(4), [M.delete()])
    out = [
        table.state(v).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").cast("double").alias("quantity")).select(F.lit(v).alias("version"), "*")
        for v in (0, 3)
    ]
    return out[0].unionByName(out[1])


# -- constraints and conditional writes ----------------------------------


@query("constraint_violations", "Q1 Q2", """SELECT COUNT(*) FILTER (o_custkey IS NULL) AS o_custkey_not_null,
    COUNT(*) FILTER (NOT (o_totalprice > 2000)) AS real_price, COUNT(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS known_status FROM orders""")
def constraint_violations(t):
    rules = [
        Q.Constraint.not_null("o_custkey"),
        Q.Constraint.check("real_price", "o_totalprice > 2000"),
        Q.Constraint.check("known_status", "o_orderstatus in ('F', 'O')"),
    ]
    return Q.violations(t.orders, rules)


@query("constrained_writes", "Q1 Q2 Q3 K3", """SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'O' AND o_totalprice > 50000""")
def constrained_writes(t):
    """Constraints stored with a table of orders. The batch with cheap orders is refused whole, the one without is taken."""
    path = work_dir(t.spark, "constrained")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    rows.where("o_orderstatus = 'O'").write.parquet(path)
    G.add_constraint(t.spark, path, Q.Constraint.not_null("o_custkey"))
    G.add_constraint(t.spark, path, Q.Constraint.check("some_price", "o_totalprice > 0"))
    G.add_constraint(t.spark, path, Q.Constraint.check("real_price", "o_totalprice > 50000 or o_orderstatus = 'O'"))
    rest = rows.where("o_orderstatus <> 'O'")
    try:
        G.append(rest, path)
    except Exception as refused:
        if "violating rows: real_price" not in str(refused):
            raise
    G.append(rest.where("o_totalprice > 50000"), path)
    return t.spark.read.parquet(path)


@query("constrained_merge", "Q1 Q3 M1", """SELECT o_orderkey, o_orderstatus, o_totalprice + CASE WHEN o_orderpriority = '1-URGENT' THEN 1000 ELSE 0 END AS o_totalprice FROM orders""")
def constrained_merge(t):
    """A merge that would break a constraint of its table leaves it as it is; one that would not goes through."""
    path = work_dir(t.spark, "constrained")
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    rows.write.partitionBy("o_orderstatus").parquet(path)
    G.add_constraint(t.spark, path, Q.Constraint.check("some_price", "o_totalprice > 0"))
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_orderstatus")
    on, by = ["o_orderkey", "o_orderstatus"], ["o_orderstatus"]
    try:
        G.merge_into(path, urgent, on, by, [M.update({"o_totalprice": "-t.o_totalprice"})])
    except Exception as refused:
        if "violating rows: some_price" not in str(refused):
            raise
    G.merge_into(path, urgent, on, by, [M.update({"o_totalprice": "t.o_totalprice + 1000"})])
    return t.spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "o_totalprice")


RULES = [
    Q.Rule("valid_customer", "o_custkey is not null", "drop"),
    Q.Rule("real_price", "o_totalprice > 2000", "drop"),
    Q.Rule("known_priority", "o_orderpriority <> '4-NOT SPECIFIED'", "warn"),
    Q.Rule("has_key", "o_orderkey >= 0", "fail"),
]


@query("expectations_kept", "Q5", "SELECT * FROM orders WHERE o_custkey IS NOT NULL AND o_totalprice > 2000")
def expectations_kept(t):
    return Q.expect(t.orders, RULES)[0]


@query("expectations_metrics", "Q5", """SELECT rule, on_fail, passed, total - passed AS failed FROM (
    SELECT COUNT(*) AS total, COUNT(*) FILTER (o_custkey IS NOT NULL) AS a, COUNT(*) FILTER (o_totalprice > 2000) AS b,
      COUNT(*) FILTER (o_orderpriority <> '4-NOT SPECIFIED') AS c, COUNT(*) FILTER (o_orderkey >= 0) AS d FROM orders),
    LATERAL (VALUES ('valid_customer', 'drop', a), ('real_price', 'drop', b), ('known_priority', 'warn', c), ('has_key', 'fail', d)) x(rule, on_fail, passed)""")
def expectations_metrics(t):
    return Q.expect(t.orders, RULES)[1]


@query("quality_report", "Q8 A17", """WITH r AS (
    SELECT 'bronze' AS tier, 'null_order' AS check_name, COUNT(*) AS total_rows, COUNT(*) FILTER (l_orderkey IS NULL) AS failed_rows FROM lineitem
    UNION ALL SELECT 'bronze', 'date_range', COUNT(*), COUNT(*) FILTER (l_shipdate < TIMESTAMP '1995-06-01' OR l_shipdate > TIMESTAMP '2001-06-01') FROM lineitem
    UNION ALL SELECT 'bronze', 'high_discount', COUNT(*), COUNT(*) FILTER (l_discount > 0.09) FROM lineitem
    UNION ALL SELECT 'silver', 'orphan_order', COUNT(*), COUNT(*) FILTER (o_orderkey IS NULL) FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey
    UNION ALL SELECT 'gold', 'few_orders', COUNT(*), COUNT(*) FILTER (n < 3) FROM (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey))
    SELECT *, CAST(total_rows - failed_rows AS DOUBLE) / total_rows AS pass_rate FROM r""")
def quality_report(t):
    day_ok = "l_shipdate between timestamp_ntz'1995-06-01' and timestamp_ntz'2001-06-01'"
    parents = t.orders.where("o_orderstatus <> 'P'").select("o_orderkey")
    checked = t.lineitem.join(parents, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return Q.quality_report(
        [
            ("bronze", t.lineitem, {
                "null_order": F.col("l_orderkey").isNull(),
                "date_range": ~F.expr(day_ok),
                "high_discount": F.col("l_discount") > 0.09,
            }),
            ("silver", checked, {"orphan_order": F.col("o_orderkey").isNull()}),
            ("gold", t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")), {"few_orders": F.col("n") < 3}),
        ]
    )


@query("replace_where", "K6", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, o_orderstatus FROM orders""")
def replace_where(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    doubled = rows.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return M.replace_where(rows, doubled, "o_orderstatus = 'F'")


@query("update_rows", "K13", """SELECT o_orderkey, CASE WHEN o_totalprice < 5000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_totalprice < 5000 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders""")
def update_rows(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return M.update_where(rows, "o_totalprice < 5000", {"o_orderstatus": "'X'", "o_totalprice": "o_totalprice + 1"})


@query("delete_rows", "K13", "SELECT * FROM orders WHERE NOT (o_orderstatus = 'P' AND o_totalprice < 100000)")
def delete_rows(t):
    return M.delete_where(t.orders, "o_orderstatus = 'P' and o_totalprice < 100000")
