"""Projection, cleaning, nested data and user-defined functions."""

from pyspark.sql import functions as F

from ..functions import payload as P
from ..functions.measures import money, money_sum
from ..operators import clean as K
from ..operators import nested as N
from ..operators import quality as Q
from .joins import CUSTOMERS_SQL, customers
from .registry import query


@query(
    "project_with_tax",
    "P1",
    """SELECT o_orderkey, o_custkey, o_totalprice, CAST(ROUND(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(1.08 AS DECIMAL(3,2)), 2) AS DOUBLE) AS amount_with_tax
    FROM orders WHERE o_orderstatus = 'F'""",
)
def project_with_tax(t):
    taxed = F.round(money("o_totalprice") * F.lit("1.08").cast("decimal(3,2)"), 2).cast("double")
    return t.orders.where("o_orderstatus = 'F'").select(
        "o_orderkey", "o_custkey", "o_totalprice", taxed.alias("amount_with_tax")
    )


@query(
    "rename_and_cast",
    "P2",
    "SELECT c_custkey AS customer_id, c_name AS customer_name, CAST(c_nationkey AS VARCHAR) AS nation, CAST(c_acctbal AS DECIMAL(10,2)) AS balance FROM customer",
)
def rename_and_cast(t):
    return K.rename_cast(
        t.customer,
        {
            "c_custkey": ("customer_id", None),
            "c_name": ("customer_name", None),
            "c_nationkey": ("nation", "string"),
            "c_acctbal": ("balance", "decimal(10,2)"),
        },
    )


@query(
    "bucket_orders",
    "P3 P5",
    """SELECT o_orderkey, tier, CASE tier WHEN 'premium' THEN 4 WHEN 'standard' THEN 3 WHEN 'budget' THEN 2 WHEN 'free' THEN 1 ELSE 0 END AS priority_score
    FROM (SELECT o_orderkey, CASE WHEN o_orderstatus IN ('P') THEN 'inactive' WHEN o_totalprice >= 300000 THEN 'premium'
      WHEN o_totalprice >= 100000 AND o_totalprice < 300000 THEN 'standard' WHEN o_totalprice > 0 AND o_totalprice < 100000 THEN 'budget' ELSE 'free' END AS tier FROM orders)""",
)
def bucket_orders(t):
    tier = K.bucket(
        [
            (F.col("o_orderstatus").isin("P"), "inactive"),
            ("o_totalprice >= 300000", "premium"),
            ("o_totalprice >= 100000", "standard"),
            ("o_totalprice > 0", "budget"),
        ],
        "free",
    )
    scores = {"premium": 4, "standard": 3, "budget": 2, "free": 1}
    return t.orders.select("o_orderkey", tier.alias("tier")).withColumn(
        "priority_score", K.bucket([(F.col("tier") == k, v) for k, v in scores.items()], 0)
    )


@query(
    "point_lookup",
    "P4",
    "SELECT * FROM lineitem WHERE l_partkey = 96 AND l_suppkey = 7 UNION ALL SELECT * FROM lineitem WHERE l_orderkey = 42 AND l_linenumber = 1",
)
def point_lookup(t):
    line = t.lineitem
    return line.where("(l_partkey = 96 and l_suppkey = 7) or (l_orderkey = 42 and l_linenumber = 1)")


@query(
    "predicates",
    "P5",
    """SELECT p_partkey, p_name, p_type, p_size FROM part WHERE p_type IN ('SMALL', 'LARGE') AND p_size BETWEEN 5 AND 30
    AND p_name IS NOT NULL AND p_name LIKE '%bolt'""",
)
def predicates(t):
    return t.part.where(
        F.col("p_type").isin("SMALL", "LARGE")
        & F.col("p_size").between(5, 30)
        & F.col("p_name").isNotNull()
        & F.col("p_name").like("%bolt")
    ).select("p_partkey", "p_name", "p_type", "p_size")


@query("contains_text", "P6", "SELECT doc_id, lang, contains(text, 'http') AS has_link FROM documents")
def contains_text(t):
    return t.documents.select("doc_id", "lang", F.col("text").contains("http").alias("has_link"))


EMAIL_SQL = """CASE WHEN c_acctbal < 0 THEN c_name ELSE lower(replace(c_name, '#', '@')) || '.example' || CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE '.org' END END"""


def with_email(t):
    """Customers with an address derived from their name; not every one is well formed."""
    made = F.concat(
        F.lower(F.replace("c_name", F.lit("#"), F.lit("@"))),
        F.lit(".example"),
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(".org"),
    )
    return t.customer.withColumn("email", F.when(F.col("c_acctbal") < 0, F.col("c_name")).otherwise(made))


@query(
    "valid_email",
    "P7",
    f"SELECT c_custkey, email, regexp_matches(email, '{K.EMAIL_PATTERN}') AS is_valid_email FROM (SELECT *, {EMAIL_SQL} AS email FROM customer)",
)
def valid_email(t):
    return with_email(t).select("c_custkey", "email", K.is_valid_email("email").alias("is_valid_email"))


@query(
    "clean_rows",
    "P8",
    """SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(10,2)) AS amount, upper(trim(o_orderpriority)) AS priority, CAST(o_orderdate AS DATE) AS day
    FROM orders WHERE o_custkey IS NOT NULL AND o_totalprice > 1500""",
)
def clean_rows(t):
    return t.orders.dropna(subset=["o_custkey"]).where("o_totalprice > 1500").select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(10,2)").alias("amount"),
        F.upper(F.trim("o_orderpriority")).alias("priority"),
        F.to_date("o_orderdate").alias("day"),
    )


@query(
    "fill_numeric_nulls",
    "P9 P10",
    """SELECT c_custkey, COALESCE(n, 0) AS orders, COALESCE(v, 0) AS spent, COALESCE(p, 'none') AS top_priority FROM customer LEFT JOIN
    (SELECT o_custkey, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS v, MIN(o_orderpriority) AS p FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
)
def fill_numeric_nulls(t):
    done = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("orders"), money_sum("o_totalprice").alias("spent"), F.min("o_orderpriority").alias("p")
    )
    joined = t.customer.select("c_custkey").join(done, "c_custkey", "left")
    return K.fill_numbers(joined).withColumn("top_priority", F.coalesce("p", F.lit("none"))).drop("p")


@query(
    "cast_dirty_price",
    "P11",
    "SELECT p_partkey, TRY_CAST(CASE WHEN p_size < 5 THEN 'n/a' ELSE CAST(p_retailprice AS VARCHAR) END AS DECIMAL(10,2)) AS price FROM part",
)
def cast_dirty_price(t):
    dirty = t.part.withColumn("price", F.when(F.col("p_size") < 5, "n/a").otherwise(F.col("p_retailprice").cast("string")))
    return dirty.select("p_partkey", K.decimal_price("price").alias("price"))


@query(
    "flag_mismatch",
    "P12",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_nationkey <> c_nationkey AS is_mismatch
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey LEFT JOIN supplier ON l_suppkey = s_suppkey""",
)
def flag_mismatch(t):
    solvent = t.customer.where("c_acctbal > 0")
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(solvent, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            (F.col("s_nationkey") != F.col("c_nationkey")).alias("is_mismatch"),
        )
    )


def signed_lines(t):
    sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        (F.col("l_quantity") * sign).alias("quantity"), (F.col("l_extendedprice") * sign).alias("amount"),
    )


@query("sales_rows", "P13", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS quantity, l_extendedprice AS amount FROM lineitem WHERE l_returnflag <> 'R' AND l_quantity > 0")
def sales_rows(t):
    return K.split_returns(signed_lines(t), "quantity", "amount")[0]


@query("return_rows", "P13", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS returned_quantity, l_extendedprice AS returned_amount FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 0")
def return_rows(t):
    return K.split_returns(signed_lines(t), "quantity", "amount")[1]


@query("latest_day", "P14", "SELECT * FROM orders WHERE o_orderdate = (SELECT MAX(o_orderdate) FROM orders)")
def latest_day(t):
    return K.latest(t.orders, "o_orderdate")


@query("find_by_name", "P15", "SELECT * FROM part WHERE lower(p_name) LIKE '%blue%' ORDER BY p_name, p_partkey LIMIT 1")
def find_by_name(t):
    return K.find_by_name(t.part, "p_name", "Blue", ["p_name", "p_partkey"])


@query(
    "scalar_functions",
    "FN",
    """SELECT c_custkey, upper(c_mktsegment) AS up, lower(c_name) AS low, concat(upper(substr(c_mktsegment, 1, 1)), lower(substr(c_mktsegment, 2))) AS cap,
    length(c_name) AS len, substr(c_name, 10, 4) AS part, md5(c_name) AS digest, abs(c_acctbal) AS magnitude, floor(c_acctbal)::BIGINT AS whole,
    c_custkey % 7 AS rest, regexp_replace(c_name, '[^0-9]', '', 'g') AS digits, NULLIF(c_nationkey, 5) AS nation,
    datediff('day', DATE '2023-01-01', DATE '2024-01-01') AS days FROM customer""",
)
def scalar_functions(t):
    return t.customer.select(
        "c_custkey",
        F.upper("c_mktsegment").alias("up"),
        F.lower("c_name").alias("low"),
        F.initcap("c_mktsegment").alias("cap"),
        F.length("c_name").cast("bigint").alias("len"),
        F.substring("c_name", 10, 4).alias("part"),
        F.md5("c_name").alias("digest"),
        F.abs("c_acctbal").alias("magnitude"),
        F.floor("c_acctbal").alias("whole"),
        (F.col("c_custkey") % 7).alias("rest"),
        K.digits("c_name").alias("digits"),
        F.nullif("c_nationkey", F.lit(5)).alias("nation"),
        F.datediff(F.lit("2024-01-01"), F.lit("2023-01-01")).cast("bigint").alias("days"),
    )


@query(
    "scalar_dates_and_lists",
    "FN",
    """SELECT event_id, ts AS at, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, CAST(ts AS DATE) - 7 AS week_before, TRUE AS drawn, TRUE AS today,
    list_sort(list_distinct([user_id % 3, event_id % 3, 1])) AS kinds, list_sort([user_id, event_id]) AS held FROM events""",
)
def scalar_dates_and_lists(t):
    """Times from text and to seconds, days before, a draw with a seed, today, distinct elements, values of a map."""
    text = F.date_format("ts", "dd/MM/yyyy HH:mm:ss.SSSSSS")
    held = F.create_map(F.lit("user"), F.col("user_id"), F.lit("event"), F.col("event_id"))
    return t.events.select(
        "event_id",
        F.to_timestamp(text, "dd/MM/yyyy HH:mm:ss.SSSSSS").cast("timestamp_ntz").alias("at"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("seconds"),
        F.date_sub("ts", 7).alias("week_before"),
        ((F.rand(5) >= 0) & (F.rand(5) < 1)).alias("drawn"),
        (F.datediff(F.current_date(), F.date_sub(F.current_date(), 1)) == 1).alias("today"),
        F.array_sort(F.array_distinct(F.array(F.col("user_id") % 3, F.col("event_id") % 3, F.lit(1)))).alias("kinds"),
        F.array_sort(F.map_values(held)).alias("held"),
    )


# -- nested data ----------------------------------------------------------


@query(
    "flatten_struct",
    "N1",
    f"SELECT customer_id, name, CASE WHEN balance < 0 THEN NULL ELSE region END AS region, CASE WHEN balance < 0 THEN NULL ELSE tier END AS tier FROM {CUSTOMERS_SQL} c",
)
def flatten_struct(t):
    nested = customers(t).select(
        "customer_id", "name",
        F.when(F.col("balance") >= 0, F.struct("region", F.struct("tier").alias("level"))).alias("profile"),
    )
    return N.flatten(nested, {"profile.region": "region", "profile.level.tier": "tier"})


@query(
    "explode_keep_parents",
    "N2",
    """SELECT p_partkey, tag FROM part, LATERAL (SELECT unnest(string_split(p_name, ' ')) AS tag) WHERE p_size >= 5
    UNION ALL SELECT p_partkey, NULL FROM part WHERE p_size < 5""",
)
def explode_keep_parents(t):
    tags = t.part.select("p_partkey", F.when(F.col("p_size") >= 5, F.split("p_name", " ")).alias("tags"))
    return N.explode_rows(tags, "tags", "tag")


BROKEN_SQL = "CASE WHEN event_type = 'error' THEN substr(props, 2) WHEN event_type = 'signup' THEN NULL ELSE props END"


def broken_props(t):
    """Events whose props text is cut for errors and missing for signups."""
    text = F.when(F.col("event_type") == "error", F.expr("substr(props, 2)")).when(F.col("event_type") != "signup", F.col("props"))
    return t.events.select("event_id", "event_type", text.alias("payload"))


@query(
    "parse_json_text",
    "N3",
    f"SELECT event_id, event_type, payload, CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE CAST(json_extract(payload, '$.k') AS INTEGER) END AS k FROM (SELECT event_id, event_type, {BROKEN_SQL} AS payload FROM events)",
)
def parse_json_text(t):
    return N.parse_json_column(broken_props(t), "payload", "k INT", {"k": "k"})


@query(
    "map_lookup",
    "N4",
    """SELECT p_partkey, CASE WHEN p_size < 5 THEN '' ELSE 'brand,type' END AS names, CASE WHEN p_size < 5 THEN 0 ELSE 2 END AS entries,
    CASE WHEN p_size < 5 THEN NULL ELSE p_brand END AS brand, CAST(NULL AS VARCHAR) AS colour FROM part""",
)
def map_lookup(t):
    empty = F.expr("cast(map() as map<string,string>)")
    filled = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type"))
    parts = t.part.select("p_partkey", F.when(F.col("p_size") < 5, empty).otherwise(filled).alias("attributes"))
    out = N.map_summary(parts, "attributes", ["brand", "colour"], "entries", "names")
    return out.withColumn("names", F.concat_ws(",", "names")).drop("attributes")


@query(
    "transform_filter_array",
    "N5",
    "SELECT doc_id, array_to_string(list_transform(list_filter(string_split(lang || ' ' || source || ' x', ' '), lambda x: length(x) > 1), lambda x: upper(x)), ',') AS marks FROM documents",
)
def transform_filter_array(t):
    marks = t.documents.select("doc_id", F.split(F.concat_ws(" ", "lang", "source", F.lit("x")), " ").alias("marks"))
    out = N.map_and_filter(marks, "marks", F.upper, lambda x: F.length(x) > 1)
    return out.withColumn("marks", F.concat_ws(",", "marks"))


LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]


@query(
    "nest_flatten_orders",
    "N6 N7",
    "SELECT o_custkey, o_orderkey, l_linenumber, l_partkey, l_quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey",
)
def nest_flatten_orders(t):
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey").join(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey")
    orders = N.nest(
        lines, ["o_custkey", "o_orderkey"], {}, ["l_linenumber", "l_partkey", "l_quantity"], LINE_ORDER, "items"
    )
    per_customer = N.nest(orders, ["o_custkey"], {}, ["o_orderkey", "items"], ["o_orderkey", "chunk"], "orders")
    return N.flatten_orders(per_customer, ["o_custkey"], "orders", "items")


@query(
    "nest_order_items",
    "N7 A9",
    """SELECT l_orderkey, ANY_VALUE(o_orderstatus) AS status, COUNT(*) AS n_items,
    string_agg(l_partkey, ',' ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS parts FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey""",
)
def nest_order_items(t):
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    out = N.nest(
        lines, ["l_orderkey"], {"customer": ["o_custkey", "o_orderstatus"]}, ["l_partkey", "l_quantity"], LINE_ORDER, "items"
    )
    return out.select(
        "l_orderkey",
        F.col("customer.o_orderstatus").alias("status"),
        F.size("items").cast("bigint").alias("n_items"),
        F.concat_ws(",", F.col("items.l_partkey").cast("array<string>")).alias("parts"),
    )


@query(
    "order_items_summary",
    "N9",
    """SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 'high' WHEN o_totalprice >= 100000 THEN 'medium' ELSE 'low' END AS amount_bucket,
    COALESCE(n, 0) AS total_items, COALESCE(v, 0.0::DOUBLE) AS total_value FROM orders LEFT JOIN (SELECT l_orderkey, CAST(SUM(l_quantity) AS BIGINT) AS n,
      CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS v FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
)
def order_items_summary(t):
    items = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    out = N.items_summary(t.orders, items, "o_orderkey", "l_quantity", money("l_extendedprice"))
    size = K.bucket([("o_totalprice >= 300000", "high"), ("o_totalprice >= 100000", "medium")], "low")
    return out.select("o_orderkey", size.alias("amount_bucket"), "items_summary.total_items", "items_summary.total_value")


# -- functions ------------------------------------------------------------

PAYLOAD_SQL = """CASE event_type WHEN 'purchase' THEN '{"price": ' || value || '}' WHEN 'view' THEN '{"duration": 1}' WHEN 'click' THEN ''
  WHEN 'error' THEN NULL ELSE props END"""
CLASS_SQL = f"""SELECT event_id, CASE WHEN payload IS NULL OR payload = '' THEN 'no_data' WHEN contains(payload, 'price') THEN 'transaction'
  WHEN contains(payload, 'duration') THEN 'engagement' ELSE 'other' END AS payload_class FROM (SELECT event_id, {PAYLOAD_SQL} AS payload FROM events)"""


def payloads(t):
    text = F.expr(
        """case event_type when 'purchase' then concat('{"price": ', value, '}') when 'view' then '{"duration": 1}'
        when 'click' then '' when 'error' then null else props end"""
    )
    return t.events.select("event_id", text.alias("payload"))


@query("classify_by_udf", "V1", CLASS_SQL)
def classify_by_udf(t):
    return payloads(t).select("event_id", P.classify_payload_udf()("payload").alias("payload_class"))


@query("classify_native", "V3 P6", CLASS_SQL)
def classify_native(t):
    return payloads(t).select("event_id", P.classify_payload_native(F.col("payload")).alias("payload_class"))


SIDES = {"East": ["ASIA", "MIDDLE EAST"], "West": ["AMERICA"]}
SIDES_SQL = f"""SELECT customer_id, CASE WHEN region IN ('ASIA', 'MIDDLE EAST') THEN 'East' WHEN region = 'AMERICA' THEN 'West' ELSE 'Central' END AS side FROM {CUSTOMERS_SQL} c"""


@query("categorize_vectorised", "V2", SIDES_SQL)
def categorize_vectorised(t):
    return customers(t).select("customer_id", P.categorize_udf(SIDES)("region").alias("side"))


@query("categorize_native", "V2", SIDES_SQL)
def categorize_native(t):
    return customers(t).select("customer_id", P.categorize_native(F.col("region"), SIDES).alias("side"))


SCORED_SQL = f"""(SELECT c_custkey, email, c_mktsegment AS segment, regexp_matches(email, '{K.EMAIL_PATTERN}') AS is_valid_email,
  length(regexp_replace(c_name, '[^0-9]', '', 'g')) = 9 AS is_valid_phone,
  (CASE WHEN email IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN regexp_matches(email, '{K.EMAIL_PATTERN}') THEN 1 ELSE 0 END
   + CASE WHEN c_mktsegment <> 'FURNITURE' THEN 1 ELSE 0 END) AS score FROM (SELECT *, {EMAIL_SQL} AS email FROM customer))"""


@query("quality_score", "Q6 Q7", f"SELECT c_custkey, score FROM {SCORED_SQL} WHERE is_valid_email AND score >= 2")
def quality_score(t):
    checks = [F.col("email").isNotNull(), K.is_valid_email("email"), F.col("c_mktsegment") != "FURNITURE"]
    scored = with_email(t).withColumn("score", Q.quality_score(checks))
    return scored.where(K.is_valid_email("email") & (F.col("score") >= 2)).select("c_custkey", "score")
