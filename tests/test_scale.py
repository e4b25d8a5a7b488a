"""Plans that keep shuffles and parsing in proportion to the input, with their results."""

from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators.aggregates import collect_chunks
from millrace.plans import sales as L
from millrace.plans import star as S
from millrace.queries.plans import payments_risk_score
from millrace.sources.rescue import rescue_json


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_small_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lists_of_cut_groups(spark, no_small_joins):
    data = [(k, i) for k, n in (("hot", 500), ("a", 3), ("z", 2), (None, 4)) for i in range(n)]
    df = spark.createDataFrame(data, "k string, i int").repartition(3, "i")
    out = collect_chunks(df, ["k"], ["i"], F.col("i"), "l", chunk_rows=300, rows_per_task=100)
    assert "SortMergeJoin" not in plan(out)  # no shuffle of all rows to hand on a few columns
    want = [("a", 0, [0, 1, 2]), ("hot", 0, [*range(300)]), ("hot", 1, [*range(300, 500)]), ("z", 0, [0, 1]), (None, 0, [0, 1, 2, 3])]
    assert rows(out) == sorted(want, key=repr)


def test_other_months_drop_out_first(spark, no_small_joins):
    fact = spark.createDataFrame([(1, 20240101, 5), (2, 20240203, 5), (3, 20240102, 6), (4, None, 5)], "order_id int, date_key int, store_key int")
    date = spark.createDataFrame([(20240101, "2024-01"), (20240102, "2024-01"), (20240203, "2024-02")], "date_key int, year_month string")
    store = spark.createDataFrame([(5, "N"), (6, "S")], "store_key int, region string")
    out = S.Star(fact, date, None, None, store, None).rows("store", month="2024-01").select("order_id", "region")
    assert "LeftSemi" in plan(out)
    assert rows(out) == [(1, "N"), (3, "S")]


def test_distinct_counts_send_a_line_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(L, "pin", lambda df, label: seen.append(df) or df)
    data = [("p", "c", 1.0, 1, 1, 7), ("p", "c", 1.0, 1, 1, 8), ("p", "c", 1.0, 1, None, 8), ("p", "c", 1.0, 1, 2, None), ("q", None, 1.0, 1, None, None), (None, "c", 2.0, 1, 3, 9)]
    sales = spark.createDataFrame(data, "product_id string, category string, total_amount double, quantity int, order_id int, customer_id int")
    L.product_tiers(sales, bounded=True)
    assert "Expand" not in plan(seen[0])
    got = rows(seen[0], "product_id", "category", "total_orders", "unique_customers", "total_units_sold")
    assert got == sorted([("p", "c", 2, 2, 4), ("q", None, 0, 0, 1), (None, "c", 1, 1, 1)], key=repr)


def test_a_line_is_parsed_once(spark):
    lines = spark.createDataFrame([('{"a":"1","b":"x"}',), ('{"a":"1","b":"2","c":"3"}',), ("{cut",), ('{"a":null,"b":"2"}',), (None,)], "value string")
    out = rescue_json(lines, "a string, b int").where("a is not null or b is not null")
    assert plan(out).count("from_json(") == 1
    assert rows(out) == sorted([("1", None, '{"b":"x"}'), ("1", 2, '{"c":"3"}'), (None, 2, None)], key=repr)
    assert rows(rescue_json(lines, "a string, b int").where("a is null and b is null")) == sorted([(None, None, "{cut"), (None, None, None)], key=repr)


def test_lines_of_payment_are_sent_to_their_orders_only(spark, no_small_joins):
    nation = spark.createDataFrame([(1, "X"), (2, "Y")], "n_nationkey long, n_name string")
    supplier = spark.createDataFrame([(7, "s7", 1, 9000.0), (8, "s8", 2, 10.0), (None, "s", 1, 1.0)], "s_suppkey long, s_name string, s_nationkey long, s_acctbal double")
    customer = spark.createDataFrame([(3, "c3", 2, 1.0), (4, "c4", 1, -1.0), (None, "c", 1, 1.0)], "c_custkey long, c_name string, c_nationkey long, c_acctbal double")
    orders = spark.createDataFrame([(10, 3), (11, 4), (12, None), (12, 3), (None, 3)], "o_orderkey long, o_custkey long")
    data = [(10, 1, 5, 7, 1.0, 81000.5, 0.1, "A"), (10, 2, 5, 8, 1.0, 99.9, 0.0, "N"), (11, 1, 5, 7, 1.0, None, 0.1, "R"), (12, 1, None, 7, 1.0, 5.0, None, None), (None, 1, 5, 7, 1.0, 5.0, 0.1, "A")]
    line = spark.createDataFrame(data, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_tax double, l_returnflag string")
    line = line.withColumn("l_shipdate", F.to_date(F.lit("2024-01-02")))
    out = payments_risk_score(SimpleNamespace(nation=nation, supplier=supplier, customer=customer, orders=orders, lineitem=line))
    text = plan(out)
    assert "concat_ws" not in text[text.index("Exchange") :]  # texts are made after the last join
    assert "l_linenumber" not in text[text.index("hashpartitioning(customer_id") :]  # orders are sent to customers, lines are not
    want = [("10-1-5-7", 90, True), ("10-2-5-8", 0, False), ("11-1-5-7", 55, False), ("12-1-7", 30, False), ("12-1-7", 30, False)]
    assert rows(out) == sorted(want, key=repr)
