"""Sources and sinks: the driver tables are written as files and read back."""

import os

from pyspark.sql import functions as F

from ..operators import layout as L
from ..operators import merge as M
from ..operators.setops import union_evolving
from ..session import work_dir
from ..sources import files as S
from ..sources import headers as H
from ..sources import ingest as I
from ..sources import rescue as R
from ..sources import sinks as K
from .joins import CUSTOMERS_SQL
from .registry import query

ORDER_DDL = "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderstatus STRING, o_orderdate DATE"
ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders"


def plain_orders(t):
    return t.orders.selectExpr("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "cast(o_orderdate as date) as o_orderdate")


@query("read_csv_pipe", "S1", ORDERS_SQL)
def read_csv_pipe(t):
    path = work_dir(t.spark, "csv")
    plain_orders(t).write.option("sep", "|").option("header", True).csv(path)
    out = S.read_csv(t.spark, path, sep="|")
    return out.select(F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), "o_totalprice", "o_orderstatus", "o_orderdate")


@query("read_json_declared", "S2", ORDERS_SQL)
def read_json_declared(t):
    path = work_dir(t.spark, "json")
    plain_orders(t).write.json(path)
    return S.read_json(t.spark, path, ORDER_DDL)


@query(
    "read_json_nested",
    "S3 N1",
    f"SELECT customer_id, name, region, tier FROM {CUSTOMERS_SQL} c",
)
def read_json_nested(t):
    from .joins import customers

    path = work_dir(t.spark, "nested")
    customers(t).select("customer_id", F.struct("name", F.struct("region", "tier").alias("place")).alias("profile")).write.json(path)
    return S.read_json(t.spark, path).select("customer_id", "profile.name", "profile.place.region", "profile.place.tier")


@query("read_parquet_pruned", "S4", "SELECT l_partkey, l_quantity FROM lineitem WHERE l_quantity > 45 AND l_returnflag = 'R'")
def read_parquet_pruned(t):
    lines = S.read_parquet(t.spark, os.path.join(t.sf_dir, "lineitem.parquet"))
    return lines.where("l_quantity > 45 and l_returnflag = 'R'").select("l_partkey", "l_quantity")


@query("read_csv_dimension", "S5", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def read_csv_dimension(t):
    path = work_dir(t.spark, "dim")
    t.supplier.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal").write.option("header", True).csv(path)
    return S.read_csv(t.spark, path, schema="s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE")


def broken_csv(t):
    """Order lines as CSV text; urgent ones have text where the price belongs."""
    path = work_dir(t.spark, "lines")
    price = F.expr("if(o_orderpriority = '1-URGENT', 'abc', cast(o_totalprice as string))")
    t.orders.select(F.concat_ws(",", F.col("o_orderkey").cast("string"), price, "o_orderstatus").alias("value")).write.text(path)
    return S.read_csv_permissive(t.spark, path, "o_orderkey BIGINT, o_totalprice DOUBLE, o_orderstatus STRING")


@query("csv_good_rows", "S6", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderpriority <> '1-URGENT'")
def csv_good_rows(t):
    return broken_csv(t)[0]


@query("csv_bad_lines", "S6", "SELECT o_orderkey || ',abc,' || o_orderstatus AS _corrupt_record FROM orders WHERE o_orderpriority = '1-URGENT'")
def csv_bad_lines(t):
    return broken_csv(t)[1]


@query("ingest_json_twice", "S7", ORDERS_SQL)
def ingest_json_twice(t):
    root = work_dir(t.spark, "ingest")
    orders = plain_orders(t)
    sink, checkpoint = f"{root}/table", f"{root}/checkpoint"
    orders.where("o_orderstatus = 'F'").write.json(f"{root}/in")
    I.ingest_files(t.spark, f"{root}/in", "json", ORDER_DDL, checkpoint, sink)
    orders.where("o_orderstatus <> 'F'").write.mode("append").json(f"{root}/in")
    I.ingest_files(t.spark, f"{root}/in", "json", ORDER_DDL, checkpoint, sink)
    I.ingest_files(t.spark, f"{root}/in", "json", ORDER_DDL, checkpoint, sink)  # nothing new
    return t.spark.read.parquet(sink)


def dirty_lines(t):
    """Events as JSON lines: errors have text for the value, signups an unknown field, clicks are cut off."""
    return t.events.select(
        F.expr(
            """case event_type
            when 'error' then concat('{"event_id":', event_id, ',"user_id":', user_id, ',"value":"bad"}')
            when 'signup' then concat('{"event_id":', event_id, ',"user_id":', user_id, ',"value":1.5,"plan":{"a":', user_id, '}}')
            when 'click' then concat('{"event_id":', event_id, ',"user')
            else concat('{"event_id":', event_id, ',"user_id":', user_id, ',"value":', value, '}') end"""
        ).alias("value")
    )


RESCUE_SQL = """SELECT CASE WHEN event_type = 'click' THEN NULL ELSE event_id END AS event_id, CASE WHEN event_type = 'click' THEN NULL ELSE user_id END AS user_id,
    CASE WHEN event_type IN ('click', 'error') THEN NULL WHEN event_type = 'signup' THEN 1.5::DOUBLE ELSE value END AS value,
    CASE event_type WHEN 'error' THEN '{"value":"bad"}' WHEN 'signup' THEN '{"plan":"{\\"a\\":' || user_id || '}"}'
      WHEN 'click' THEN '{"event_id":' || event_id || ',"user' END AS _rescued_data FROM events"""
EVENT_DDL = "event_id BIGINT, user_id BIGINT, value DOUBLE"


@query("rescue_json_lines", "S8", RESCUE_SQL)
def rescue_json_lines(t):
    path = work_dir(t.spark, "dirty")
    dirty_lines(t).write.text(path)
    return R.rescue_json(t.spark.read.text(path), EVENT_DDL)


@query("ingest_with_rescue", "S8 S10", RESCUE_SQL)
def ingest_with_rescue(t):
    root = work_dir(t.spark, "rescue")
    dirty_lines(t).write.text(f"{root}/in")
    I.ingest_files(t.spark, f"{root}/in", "json", EVENT_DDL, f"{root}/checkpoint", f"{root}/table", evolution="rescue")
    return t.spark.read.parquet(f"{root}/table")


@query(
    "infer_with_hints",
    "S9",
    "SELECT event_id, user_id, event_type, CAST(value AS DECIMAL(10,2)) AS value FROM events",
)
def infer_with_hints(t):
    root = work_dir(t.spark, "hints")
    t.events.select("event_id", "user_id", "event_type", "value").write.json(f"{root}/in")
    schema = S.infer_with_hints(t.spark, f"{root}/in", "json", "value DECIMAL(10,2)")
    I.ingest_files(t.spark, f"{root}/in", "json", schema, f"{root}/checkpoint", f"{root}/table")
    return t.spark.read.parquet(f"{root}/table")


@query(
    "ingest_evolving",
    "S10",
    """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority FROM orders""",
)
def ingest_evolving(t):
    root = work_dir(t.spark, "evolve")
    place = (f"{root}/checkpoint", f"{root}/table")
    old = t.orders.where("o_orderdate < timestamp_ntz'1998-01-01'").select("o_orderkey", "o_totalprice")
    old.write.json(f"{root}/in")
    schema = I.ingest_files(t.spark, f"{root}/in", "json", "o_orderkey BIGINT, o_totalprice DOUBLE", *place, evolution="add")
    new = t.orders.where("o_orderdate >= timestamp_ntz'1998-01-01'").select("o_orderkey", "o_totalprice", "o_orderpriority")
    new.write.mode("append").json(f"{root}/in")
    I.ingest_files(t.spark, f"{root}/in", "json", schema, *place, evolution="add")
    return S.read_parquet(t.spark, f"{root}/table", evolved=True)


@query(
    "csv_by_header",
    "S10 S1",
    """SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority FROM orders""",
)
def csv_by_header(t):
    """CSV files of orders, later ones with a column more in the middle and the others in another order."""
    root = work_dir(t.spark, "headers")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate")
    parts = (
        ("o_orderdate < timestamp_ntz'1998-01-01'", ["o_orderkey", "o_custkey", "o_totalprice"]),
        ("o_orderdate >= timestamp_ntz'1998-01-01' and o_custkey % 2 = 0", ["o_orderkey", "o_orderpriority", "o_custkey", "o_totalprice"]),
        ("o_orderdate >= timestamp_ntz'1998-01-01' and o_custkey % 2 = 1", ["o_totalprice", "o_orderkey", "o_orderpriority", "o_custkey"]),
    )
    for where, columns in parts:
        rows.where(where).select(columns).write.mode("append").csv(f"{root}/in", header=True)
        H.ingest_by_header(t.spark, f"{root}/in", "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE", f"{root}/checkpoint", f"{root}/table")
    return S.read_parquet(t.spark, f"{root}/table", evolved=True).drop("batch_id")


@query("union_evolving", "S10 U4", "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def union_evolving_rows(t):
    return union_evolving(
        t.customer.selectExpr("c_custkey as id", "c_name as name", "c_mktsegment as segment"),
        t.supplier.selectExpr("s_suppkey as id", "s_name as name"),
    )


@query("ingest_csv_pipe", "S11", ORDERS_SQL)
def ingest_csv_pipe(t):
    root = work_dir(t.spark, "pipe")
    plain_orders(t).write.option("sep", "|").option("header", True).csv(f"{root}/in")
    options = {"sep": "|", "header": True}
    schema = S.infer_with_hints(
        t.spark, f"{root}/in", "csv", "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE", **options
    )
    I.ingest_files(t.spark, f"{root}/in", "csv", schema, f"{root}/checkpoint", f"{root}/table", **options)
    return t.spark.read.parquet(f"{root}/table")


@query("load_once", "S12", ORDERS_SQL)
def load_once(t):
    root = work_dir(t.spark, "load")
    orders = plain_orders(t)
    args = (t.spark, f"{root}/in", "json", f"{root}/table", f"{root}/manifest", ORDER_DDL)
    orders.where("o_orderstatus = 'F'").write.json(f"{root}/in")
    I.load_once(*args)
    orders.where("o_orderstatus <> 'F'").write.mode("append").json(f"{root}/in")
    I.load_once(*args)
    I.load_once(*args)  # loads nothing
    return I.read_loaded(t.spark, f"{root}/table")


@query("load_once_after_crash", "S12", ORDERS_SQL)
def load_once_after_crash(t):
    """The first load lost its end mark; a new file came before it was repeated."""
    root = work_dir(t.spark, "load")
    orders = plain_orders(t)
    source = (t.spark, f"{root}/in", "json", f"{root}/table")
    orders.where("o_orderstatus = 'F'").write.json(f"{root}/in")
    I.load_once(*source, f"{root}/manifest", ORDER_DDL)
    t.spark.read.parquet(f"{root}/manifest").where("path is not null").write.parquet(f"{root}/broken")
    orders.where("o_orderstatus <> 'F'").write.mode("append").json(f"{root}/in")
    I.load_once(*source, f"{root}/broken", ORDER_DDL)
    return I.read_loaded(t.spark, f"{root}/table")


@query(
    "lineage_columns",
    "S14",
    "SELECT r_regionkey, r_name, 'region.parquet' AS source_file, TRUE AS has_time FROM region UNION ALL SELECT n_nationkey, n_name, 'nation.parquet', TRUE FROM nation",
)
def lineage_columns(t):
    a, b = (S.with_lineage(x) for x in (t.region, t.nation))
    both = a.select("r_regionkey", "r_name", "source_file_path", "ingest_timestamp").union(
        b.select("n_nationkey", "n_name", "source_file_path", "ingest_timestamp")
    )
    return both.select(
        "r_regionkey", "r_name",
        F.element_at(F.split("source_file_path", "/"), -1).alias("source_file"),
        F.col("ingest_timestamp").isNotNull().alias("has_time"),
    )


@query(
    "unify_formats",
    "S15 U4",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier
    UNION ALL SELECT p_partkey, p_name, p_retailprice FROM part""",
)
def unify_formats(t):
    root = work_dir(t.spark, "formats")
    t.customer.write.option("header", True).csv(f"{root}/customer")
    t.supplier.write.json(f"{root}/supplier")
    return S.unify(
        [
            (S.read_csv(t.spark, f"{root}/customer"), {"id": ("c_custkey", "bigint"), "name": ("c_name", "string"), "balance": ("c_acctbal", "double")}),
            (S.read_json(t.spark, f"{root}/supplier"), {"id": ("s_suppkey", "bigint"), "name": ("s_name", "string"), "balance": ("s_acctbal", "double")}),
            (t.part, {"id": ("p_partkey", "bigint"), "name": ("p_name", "string"), "balance": ("p_retailprice", "double")}),
        ]
    )


@query(
    "inline_values",
    "S16",
    "SELECT label, COUNT(*) AS orders FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'pending')) v(status, label) ON o_orderstatus = status GROUP BY label",
)
def inline_values(t):
    labels = t.spark.sql("SELECT * FROM VALUES ('F', 'finished'), ('O', 'open'), ('P', 'pending') AS v(status, label)")
    counts = t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    return counts.join(labels, F.col("o_orderstatus") == F.col("status")).select("label", "orders")


# -- sinks ----------------------------------------------------------------


@query("write_and_append", "K1 K2", "SELECT o_orderkey, o_totalprice FROM orders")
def write_and_append(t):
    path = work_dir(t.spark, "table")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    K.write(rows.where("o_orderstatus = 'F'").drop("o_orderstatus"), path)
    K.append(rows.where("o_orderstatus <> 'F'").drop("o_orderstatus"), path)
    return K.read(t.spark, path)


@query("append_enforced", "K3", "SELECT o_orderkey, o_totalprice FROM orders")
def append_enforced(t):
    path = work_dir(t.spark, "strict")
    done = "o_orderstatus = 'F'"
    K.write(t.orders.where(done).select("o_orderkey", "o_totalprice"), path)
    schema = K.read(t.spark, path).schema
    late = t.orders.where(f"not {done}").withColumn("o_totalprice", F.col("o_totalprice").cast("string"))
    try:
        K.append_enforced(late, path)  # extra columns, other type: refused
    except K.SchemaMismatch:
        K.append_enforced(K.conform(late, schema), path)
    return K.read(t.spark, path)


@query("append_evolving", "K4", "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority FROM orders")
def append_evolving(t):
    path = work_dir(t.spark, "wider")
    K.write(t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), path)
    K.append_evolve(t.orders.where("o_orderstatus <> 'F'").select("o_orderkey", "o_totalprice", "o_orderpriority"), path)
    return K.read(t.spark, path, evolved=True)


@query("overwrite_schema", "K5", "SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority FROM orders")
def overwrite_schema(t):
    path = work_dir(t.spark, "replaced")
    K.write(t.orders, path)
    K.overwrite_schema(t.orders.select(F.col("o_orderkey").cast("string").alias("id"), "o_orderpriority"), path)
    return K.read(t.spark, path)


@query("write_partitioned", "K7 K9", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem WHERE l_returnflag = 'R'")
def write_partitioned(t):
    path = work_dir(t.spark, "partitioned")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    K.write(rows, path, partition_by=["l_returnflag"], max_records_per_file=5_000_000)
    return K.read(t.spark, path).where("l_returnflag = 'R'")  # reads one folder


@query(
    "replace_partitions",
    "K6 K7",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderstatus FROM orders",
)
def replace_partitions(t):
    path = work_dir(t.spark, "dynamic")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    K.write(rows, path, partition_by=["o_orderstatus"])
    K.replace_partitions(rows.where("o_orderstatus = 'P'").withColumn("o_totalprice", F.col("o_totalprice") + 1), path, ["o_orderstatus"])
    return K.read(t.spark, path)


@query("insert_overwrite", "K12", "SELECT o_orderstatus, COUNT(*) AS orders FROM orders GROUP BY 1")
def insert_overwrite(t):
    path = work_dir(t.spark, "result")
    K.write(t.orders.where("o_orderstatus = 'F'").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders")), path)
    K.overwrite(t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders")), path)
    return K.read(t.spark, path)


@query(
    "merge_into_partitions",
    "M1 K7",
    """SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year
    FROM orders""",
)
def merge_into_partitions(t):
    path = work_dir(t.spark, "by-year")
    rows = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    K.write(rows.where("year < 2001"), path, partition_by=["year"])
    late = rows.where("year >= 2000").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    K.merge_into(path, late, ["year", "o_orderkey"], ["year"], keyed=True, check=False)
    return K.read(t.spark, path)


@query(
    "merge_into_empties_partition",
    "M7 K7",
    """SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
    WHERE year(o_orderdate) <> (SELECT MAX(year(o_orderdate)) FROM orders)""",
)
def merge_into_empties_partition(t):
    path = work_dir(t.spark, "by-year")
    rows = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    K.write(rows, path, partition_by=["year"])
    gone = rows.join(rows.agg(F.max("year").alias("year")), "year")
    K.merge_into(path, gone, ["year", "o_orderkey"], ["year"], [M.delete()], keyed=True, check=False)
    return K.read(t.spark, path)


# -- file layout ----------------------------------------------------------


def many_files(t, label, parts=24):
    path = work_dir(t.spark, label)
    t.lineitem.repartition(parts).write.parquet(path)
    return path


LOOKUP = "l_partkey = 96 and l_suppkey = 7"


@query("file_statistics", "L1", "SELECT CAST(24 AS BIGINT) AS files, TRUE AS has_bytes, COUNT(*) AS rows FROM lineitem")
def file_statistics(t):
    return L.file_stats(t.spark, many_files(t, "stats")).select("files", (F.col("bytes") > 0).alias("has_bytes"), "rows")


@query("compact_files", "L2", "SELECT * FROM lineitem")
def compact_files(t):
    path = many_files(t, "small")
    out = work_dir(t.spark, "compact")
    L.compact(t.spark, path, out, target_bytes=128 * 1024 * 1024)
    return t.spark.read.parquet(out)


@query("zorder_layout", "L3", "SELECT * FROM lineitem")
def zorder_layout(t):
    out = work_dir(t.spark, "zorder")
    L.zorder(t.lineitem, ["l_partkey", "l_suppkey"], parts=16).write.parquet(out)
    return t.spark.read.parquet(out)


@query("zorder_text", "L3", "SELECT * FROM orders")
def zorder_text(t):
    out = work_dir(t.spark, "zorder-text")
    L.zorder(t.orders, ["o_orderstatus", "o_orderpriority", "o_custkey"], parts=16).write.parquet(out)
    return t.spark.read.parquet(out)


@query("cluster_layout", "L4 K8", "SELECT * FROM lineitem")
def cluster_layout(t):
    out = work_dir(t.spark, "cluster")
    L.write_clustered(t.lineitem, out, ["l_suppkey", "l_partkey"], parts=16)
    return t.spark.read.parquet(out)


@query("sized_write", "L5", "SELECT * FROM lineitem")
def sized_write(t):
    out = work_dir(t.spark, "sized")
    L.write_sized(t.lineitem, out, rows_per_file=1_000_000)
    return t.spark.read.parquet(out)


@query("migrate_layout", "K14 L4", "SELECT * FROM orders")
def migrate_layout(t):
    old, new = work_dir(t.spark, "old"), work_dir(t.spark, "new")
    K.write(t.orders, old, partition_by=["o_orderstatus"])
    L.migrate_layout(t.spark, old, new, ["o_custkey"], parts=8)
    return t.spark.read.parquet(new)


@query(
    "layout_scan_cost",
    "L6 B30",
    f"""SELECT layout, skips_files, rows_found FROM (VALUES ('raw', FALSE), ('partitioned', FALSE), ('zorder', TRUE), ('clustered', TRUE)) v(layout, skips_files),
    (SELECT COUNT(*) AS rows_found FROM lineitem WHERE {LOOKUP})""",
)
def layout_scan_cost(t):
    return lookup_study(t).select("layout", (F.col("files_touched") < F.col("files")).alias("skips_files"), "rows_found")


def lookup_study(t):
    """Files and bytes one lookup must read in four layouts of the line items."""
    raw = many_files(t, "raw", 16)
    by_flag, z, c = (work_dir(t.spark, x) for x in ("flag", "z", "c"))
    K.write(t.lineitem, by_flag, partition_by=["l_returnflag"])
    L.zorder(t.lineitem, ["l_partkey", "l_suppkey"], parts=16).write.parquet(z)
    L.write_clustered(t.lineitem, c, ["l_partkey", "l_suppkey"], parts=16)
    layouts = {"raw": raw, "partitioned": by_flag, "zorder": z, "clustered": c}
    return L.scan_cost(t.spark, layouts, {"l_partkey": 96, "l_suppkey": 7})
