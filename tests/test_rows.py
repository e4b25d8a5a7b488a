from conftest import rows
from pyspark.sql import functions as F

from millrace.functions import payload as P
from millrace.operators import aggregates as A
from millrace.operators import clean as K
from millrace.operators import joins as J
from millrace.operators import nested as N
from millrace.operators.setops import changed_rows


def test_explode_and_arrays(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "id int, tags array<string>")
    assert rows(N.explode_rows(df, "tags", "tag")) == [(1, "a"), (1, "b"), (2, None), (3, None)]
    assert N.explode_rows(df, "tags", "tag", outer=False).count() == 2
    out = N.map_and_filter(df, "tags", F.upper, lambda x: x != "b")
    assert [r.tags for r in out.orderBy("id").collect()] == [["A"], [], None]


def test_json_map_struct(spark):
    df = spark.createDataFrame([(1, '{"price": 2.5}'), (2, "{broken"), (3, None)], "id int, payload string")
    assert rows(N.parse_json_column(df, "payload", "price DOUBLE", {"price": "price"}), "id", "price") == [(1, 2.5), (2, None), (3, None)]
    maps = spark.createDataFrame([(1, {"color": "red", "size": "L"}), (2, {})], "id int, m map<string,string>")
    out = N.map_summary(maps, "m", ["color"], "n", "names")
    assert [(r.id, r.n, r.color, r.names) for r in out.orderBy("id").collect()] == [(1, 2, "red", ["color", "size"]), (2, 0, None, [])]
    nested = spark.sql("select 1 as id, named_struct('city', 'X', 'geo', named_struct('zip', '9')) as address union all select 2, null")
    assert rows(N.flatten(nested, {"address.city": "city", "address.geo.zip": "zip"})) == [(1, "X", "9"), (2, None, None)]


def test_nest_and_flatten_orders(spark):
    flat = spark.createDataFrame([("o1", None, "p", 1), ("o1", None, "q", 2), ("o2", "e@", "r", 3)], "o string, email string, sku string, qty int")
    out = N.nest(flat, ["o"], {"customer": ["email"]}, ["sku", "qty"], ["sku"], "items")
    got = {r.o: (r.customer.email, [tuple(i) for i in r["items"]]) for r in out.collect()}
    assert got == {"o1": (None, [("p", 1), ("q", 2)]), "o2": ("e@", [("r", 3)])}
    deep = spark.sql("""select 'u' as user, array(named_struct('id', 1, 'items', array(named_struct('sku', 'a'), null)),
        named_struct('id', 2, 'items', array())) as orders union all select 'v', null""")
    assert rows(N.flatten_orders(deep, ["user"], "orders", "items")) == [("u", 1, "a")]


def test_udf_and_native_agree(spark):
    df = spark.createDataFrame([(x,) for x in [None, "", "price 1", "duration", "duration and price", "else"]], "p string")
    out = rows(df.select(P.classify_payload_udf()("p").alias("u"), P.classify_payload_native(F.col("p")).alias("n")))
    assert all(u == n for u, n in out)
    assert sorted(u for u, _ in out) == ["engagement", "no_data", "no_data", "other", "transaction", "transaction"]
    places = spark.createDataFrame([("New York",), ("San Diego",), ("Austin",), (None,)], "c string")
    both = rows(places.select(P.categorize_udf()("c"), P.categorize_native(F.col("c"))))
    assert both == [("Central", "Central")] * 2 + [("East Coast", "East Coast"), ("West Coast", "West Coast")]


def test_buckets_emails_pivot(spark):
    df = spark.createDataFrame([(1, "x", 250.0), (2, "cancelled", 250.0), (3, "x", None), (4, "x", 0.0)], "id int, status string, amount double")
    tier = K.bucket([(F.col("status").isin("cancelled"), "inactive"), ("amount >= 200", "premium")], "free")
    assert rows(df.select("id", tier.alias("t"))) == [(1, "premium"), (2, "inactive"), (3, "free"), (4, "free")]
    mails = spark.createDataFrame([("a@b.co",), ("a@b",), (None,)], "e string")
    assert rows(mails.select(K.is_valid_email("e"))) == [(False,), (None,), (True,)]
    wide = A.pivot_counts(df, ["id"], "status", ["x", "cancelled"])
    assert rows(wide) == [(1, 1, 0), (2, 0, 1), (3, 1, 0), (4, 1, 0)]
    assert rows(A.unpivot(wide, ["id"], ["x", "cancelled"], "s", "n")) == [(1, "x", 1), (2, "cancelled", 1), (3, "x", 1), (4, "x", 1)]


def test_joins_with_nulls(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id int, ref int")
    parent = spark.createDataFrame([(10, "p"), (None, "q")], "key int, name string")
    assert rows(J.orphans(child, parent, [("ref", "key")]), "id") == [(2,), (3,)]
    assert rows(J.with_match(child, parent, [("ref", "key")]), "id") == [(1,)]
    a = spark.createDataFrame([(1, None), (2, "b"), (3, "c")], "id int, v string")
    b = spark.createDataFrame([(1, None), (2, "x"), (4, "d")], "id int, v string")
    assert rows(J.diff_keys(a, b, ["id"])) == [(1, "same"), (2, "changed"), (3, "removed"), (4, "added")]
    assert rows(changed_rows(a, b)) == [(2, "b"), (2, "x"), (3, "c"), (4, "d")]


def test_salted_equals_plain(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 0, id % 9) as k", "id")
    got = A.salted_agg(df, ["k"], {"n": F.count(F.lit(1)), "s": F.sum("id")}, {"n": F.sum("n"), "s": F.sum("s")}, ["id"])
    assert rows(got) == rows(df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("s")))


def test_quality_of_rfm_direction(spark):
    from millrace.plans.sales import rfm

    ltv = spark.range(10).selectExpr("id as customer_id", "cast(id as int) as days_since_last_purchase", "id as total_orders", "id * 2000.0D as total_spend")
    out = {r.customer_id: r for r in rfm(ltv).collect()}
    assert out[0].recency_score == 5 and out[9].recency_score == 1
    assert out[9].monetary_score == 5 and out[9].ltv_category == "High Value"
