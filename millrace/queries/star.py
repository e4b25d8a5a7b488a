"""The sales star on the driver tables: parts are products, suppliers stores."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..plans import star as S
from .joins import CUSTOMERS_SQL, customers
from .registry import query

MONTH, BEFORE = "2001-07", "2001-06"


def star(t) -> S.Star:
    date = t.orders.select(F.col("o_orderdate").cast("date").alias("day")).distinct().select(
        F.date_format("day", "yyyyMMdd").cast("int").alias("date_key"),
        F.date_format("day", "yyyy-MM").alias("year_month"),
        F.concat(F.year("day").cast("string"), F.lit("-Q"), F.quarter("day").cast("string")).alias("quarter"),
        F.dayofweek("day").isin(1, 7).alias("is_weekend"),
    )
    product = t.part.select(
        F.col("p_partkey").alias("product_key"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast("decimal(18,4)").alias("list_price"),
        (F.col("p_retailprice").cast("decimal(18,4)") * F.expr("0.8BD")).cast("decimal(18,4)").alias("unit_cost"),
    )
    signup = t.orders.groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("signup_date"))
    tier = F.when(F.col("balance") >= 8000, "VIP").when(F.col("balance") >= 4000, "Plus").otherwise("Standard")
    customer = customers(t).join(signup, F.col("customer_id") == F.col("o_custkey")).select(
        F.col("customer_id").alias("customer_key"), F.col("region").alias("customer_region"), tier.alias("loyalty_tier"), "signup_date"
    )
    nation = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    store = t.supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("store_key"),
        F.col("r_name").alias("region"),
        F.when(F.col("s_acctbal") > 5000, "Online").otherwise("Retail").alias("channel"),
    )
    net = F.expr("cast(l_extendedprice * (1 - l_discount) as decimal(18,4))")
    cost = F.expr("cast(cast(l_quantity as decimal(18,0)) * cast(cast(p_retailprice as decimal(18,4)) * 0.8BD as decimal(18,4)) as decimal(18,4))")
    fact = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("date_key"),
            F.col("l_partkey").alias("product_key"),
            F.col("o_custkey").alias("customer_key"),
            F.col("l_suppkey").alias("store_key"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            net.alias("net_sales"),
            (net - cost).cast("decimal(18,4)").alias("gross_margin"),
            F.expr("cast(l_extendedprice * l_discount as decimal(18,4))").alias("discount_amount"),
        )
    )
    # the target of a month: 2 % above the revenue of the month before it with sales
    monthly = fact.join(date, "date_key").join(store, "store_key").groupBy("region", "year_month").agg(F.sum("net_sales").alias("r"))
    by_month = Window.partitionBy("region").orderBy("year_month")  # one row per month
    targets = monthly.select(
        "region", "year_month", (F.lag("r").over(by_month).cast("double") * 1.02).alias("revenue_target")
    )
    return S.Star(fact, date, product, customer, store, targets)


STAR_SQL = f"""WITH dim_date AS (SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, strftime(o_orderdate, '%Y-%m') AS year_month,
    CAST(year(o_orderdate) AS VARCHAR) || '-Q' || quarter(o_orderdate) AS quarter, dayofweek(o_orderdate) IN (0, 6) AS is_weekend FROM orders),
  dim_product AS (SELECT p_partkey AS product_key, 'SKU-' || p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
    CAST(p_retailprice AS DECIMAL(18,4)) AS list_price, CAST(CAST(p_retailprice AS DECIMAL(18,4)) * CAST(0.8 AS DECIMAL(2,1)) AS DECIMAL(18,4)) AS unit_cost FROM part),
  dim_customer AS (SELECT customer_id AS customer_key, region AS customer_region, CASE WHEN balance >= 8000 THEN 'VIP' WHEN balance >= 4000 THEN 'Plus' ELSE 'Standard' END AS loyalty_tier, signup_date
    FROM {CUSTOMERS_SQL} c JOIN (SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS signup_date FROM orders GROUP BY 1) ON customer_id = o_custkey),
  dim_store AS (SELECT s_suppkey AS store_key, r_name AS region, CASE WHEN s_acctbal > 5000 THEN 'Online' ELSE 'Retail' END AS channel FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
  fact AS (SELECT l_orderkey AS order_id, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, l_partkey AS product_key, o_custkey AS customer_key, l_suppkey AS store_key, CAST(l_quantity AS BIGINT) AS quantity,
    CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS net_sales,
    CAST(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) - CAST(CAST(l_quantity AS DECIMAL(8,0)) * unit_cost AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS gross_margin,
    CAST(l_extendedprice * l_discount AS DECIMAL(18,4)) AS discount_amount FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN dim_product ON l_partkey = product_key),
  f AS (SELECT * FROM fact JOIN dim_date USING (date_key) JOIN dim_product USING (product_key) JOIN dim_customer USING (customer_key) JOIN dim_store USING (store_key)),
  targets AS (SELECT region, year_month, CAST(LAG(SUM(net_sales)) OVER (PARTITION BY region ORDER BY year_month) AS DOUBLE) * 1.02::DOUBLE AS revenue_target FROM f GROUP BY region, year_month)"""


def sql(body):
    return f"{STAR_SQL} {body}"


MEASURES = """CAST(SUM(net_sales) AS DOUBLE) AS revenue, CAST(SUM(gross_margin) AS DOUBLE) AS margin, ROUND(CAST(SUM(gross_margin) AS DOUBLE) * 100 / NULLIF(CAST(SUM(net_sales) AS DOUBLE), 0), 1) AS margin_pct,
  CAST(SUM(quantity) AS BIGINT) AS units, COUNT(DISTINCT order_id) AS orders, ROUND(CAST(SUM(net_sales) AS DOUBLE) / NULLIF(COUNT(DISTINCT order_id), 0), 2) AS avg_order_value"""
NOW = f"year_month = '{MONTH}'"


def measures_sql(by, where=NOW):
    return sql(f"SELECT {by}, {MEASURES} FROM f WHERE {where} GROUP BY ALL")


@query(
    "star_company_pacing",
    "B23 J11 P14",
    sql(f"""SELECT ROUND(a) AS company_actual_revenue, ROUND(t) AS company_target, ROUND(a - t) AS gap_to_target, ROUND(a * 100 / t, 1) AS pct_to_target,
    CASE WHEN a >= t THEN 'ON TRACK' ELSE 'OFF TRACK' END AS status FROM (SELECT CAST(SUM(r) AS DOUBLE) AS a, SUM(revenue_target) AS t
    FROM (SELECT region, SUM(net_sales) AS r FROM f WHERE year_month = (SELECT MAX(year_month) FROM dim_date) GROUP BY region) JOIN (SELECT * FROM targets WHERE year_month = (SELECT MAX(year_month) FROM dim_date)) USING (region))"""),
)
def star_company_pacing(t):
    s = star(t)
    return S.company_pacing(s, s.current_month())


@query(
    "star_region_pacing",
    "B23 B28",
    sql(f"""SELECT region, ROUND(a) AS actual_revenue, ROUND(revenue_target) AS revenue_target, ROUND(a - revenue_target) AS gap_to_target, ROUND(a * 100 / revenue_target, 1) AS pct_to_target,
    CASE WHEN a >= revenue_target THEN 'ON TRACK' ELSE 'OFF TRACK' END AS status FROM (SELECT region, CAST(SUM(net_sales) AS DOUBLE) AS a FROM f WHERE {NOW} GROUP BY region) JOIN targets USING (region) WHERE {NOW}"""),
)
def star_region_pacing(t):
    return S.region_pacing(star(t), MONTH)


@query(
    "star_top_products",
    "B24 B28 O2",
    measures_sql("product_id, product_name, category") + " ORDER BY revenue DESC, product_id LIMIT 10",
)
def star_top_products(t):
    return S.top_products(star(t), MONTH)


@query("star_channels", "B24 B28 B29", measures_sql("channel"))
def star_channels(t):
    return S.breakdown(star(t).rows("store", month=MONTH), ["channel"])


@query("star_categories", "B24 B28 B29 A14", measures_sql("category"))
def star_categories(t):
    return S.breakdown(star(t).rows("product", month=MONTH), ["category"])


@query("star_monthly_trend", "B24 B28", measures_sql("year_month", "TRUE"))
def star_monthly_trend(t):
    return S.breakdown(star(t).rows("date"), ["year_month"])


@query("star_loyalty_tiers", "B24", measures_sql("loyalty_tier"))
def star_loyalty_tiers(t):
    return S.breakdown(star(t).rows("customer", month=MONTH), ["loyalty_tier"])


@query("star_order_value_by_region", "B24 A6", measures_sql("region"))
def star_order_value_by_region(t):
    return S.breakdown(star(t).rows("store", month=MONTH), ["region"])


@query("star_line_detail", "B28 J11", sql(f"SELECT order_id, year_month, region, channel, category, product_name, loyalty_tier, quantity, net_sales, gross_margin FROM f WHERE {NOW}"))
def star_line_detail(t):
    return S.line_detail(star(t), MONTH)


def growth_sql(by):
    return f"""(SELECT {by}, CAST(SUM(CASE WHEN {NOW} THEN net_sales ELSE 0 END) AS DOUBLE) AS revenue_current, CAST(SUM(CASE WHEN year_month = '{BEFORE}' THEN net_sales ELSE 0 END) AS DOUBLE) AS revenue_prior,
      CAST(SUM(CASE WHEN {NOW} THEN net_sales ELSE 0 END) - SUM(CASE WHEN year_month = '{BEFORE}' THEN net_sales ELSE 0 END) AS DOUBLE) AS revenue_delta FROM f WHERE year_month IN ('{MONTH}', '{BEFORE}') GROUP BY ALL)"""


DRIVERS = f""", c AS {growth_sql('region, category')}, dec AS (SELECT region, CAST(SUM(CAST(revenue_delta AS DECIMAL(18,4))) FILTER (revenue_delta < 0) AS DOUBLE) AS decline FROM c GROUP BY region),
  w AS (SELECT region, category FROM c QUALIFY ROW_NUMBER() OVER (PARTITION BY region ORDER BY revenue_delta, category) = 1),
  p AS (SELECT * FROM {growth_sql('region, category, product_id')} JOIN w USING (region, category) WHERE revenue_delta < 0 QUALIFY ROW_NUMBER() OVER (PARTITION BY region ORDER BY revenue_delta, product_id) <= 3),
  b AS (SELECT region, 'CATEGORY' AS driver_type, category AS dimension_value, category, revenue_current, revenue_prior, revenue_delta FROM c
    UNION ALL SELECT region, 'PRODUCT', product_id, category, revenue_current, revenue_prior, revenue_delta FROM p),
  r AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY region ORDER BY revenue_delta, driver_type, dimension_value) AS INTEGER) AS rank FROM b),
  g AS (SELECT r.*, round_even(revenue_delta * 100 / decline, 1) AS contribution_to_gap_pct, format('{{:,}}', CAST(round_even(revenue_prior, 0) AS BIGINT)) AS pr, format('{{:,}}', CAST(round_even(revenue_current, 0) AS BIGINT)) AS cu,
    format('{{:,}}', CAST(abs(round_even(revenue_delta, 0)) AS BIGINT)) AS de FROM r JOIN dec USING (region) WHERE rank <= 8),
  ins AS (SELECT region, '{MONTH}' AS year_month, rank, driver_type, dimension_value, round_even(revenue_current, 0) AS revenue_current, round_even(revenue_prior, 0) AS revenue_prior, round_even(revenue_delta, 0) AS revenue_delta,
    contribution_to_gap_pct, region || ' / ' || category || CASE WHEN driver_type = 'PRODUCT' THEN ' / ' || dimension_value ELSE '' END || ': ' || CASE WHEN revenue_delta < 0 THEN 'down $' ELSE 'up $' END || de
      || ', $' || pr || ' before, $' || cu || ' now; ' || CAST(CAST(round_even(abs(COALESCE(contribution_to_gap_pct, 0)), 0) AS BIGINT) AS VARCHAR) || '% of all losses' AS insight FROM g)"""


@query("star_gap_drivers", "B25 W7", sql(f"{DRIVERS} SELECT * FROM ins"))
def star_gap_drivers(t):
    return S.gap_drivers(star(t), MONTH, BEFORE)


WHAT_IF = """(SELECT product_key, product_id, product_name, ROUND(CAST(list_price AS DOUBLE), 2) AS list_price, CAST(unit_cost AS DOUBLE) AS uc, CAST(ROUND(list_price * CAST(0.85 AS DECIMAL(9,6)), 2) AS DOUBLE) AS discounted_price,
  CAST(SUM(quantity) AS DOUBLE) / 12.0::DOUBLE AS u, CAST(SUM(net_sales) AS DOUBLE) / 12.0::DOUBLE AS rv, CAST(SUM(gross_margin) AS DOUBLE) / 12.0::DOUBLE AS mg
  FROM fact JOIN dim_product USING (product_key) GROUP BY ALL)"""
WHAT_IF_COLUMNS = """product_id, discounted_price, ROUND(u, 0) AS baseline_monthly_units, ROUND(u * (1 + 1.5::DOUBLE * 15 / 100.0::DOUBLE), 0) AS projected_monthly_units,
  ROUND(u * (1 + 1.5::DOUBLE * 15 / 100.0::DOUBLE) * discounted_price, 0) AS projected_monthly_revenue, ROUND(u * (1 + 1.5::DOUBLE * 15 / 100.0::DOUBLE) * (discounted_price - uc), 0) AS projected_monthly_margin,
  ROUND((discounted_price - uc) * 100 / NULLIF(discounted_price, 0), 1) AS projected_margin_pct, discounted_price > uc AND (discounted_price - uc) * 100 / NULLIF(discounted_price, 0) >= 15 AS margin_safe"""


@query(
    "star_discount_what_if",
    "B26",
    sql(f"SELECT product_name, list_price, 15.0::DOUBLE AS discount_pct, ROUND(rv, 0) AS baseline_monthly_revenue, ROUND(mg, 0) AS baseline_monthly_margin, {WHAT_IF_COLUMNS} FROM {WHAT_IF}"),
)
def star_discount_what_if(t):
    return S.discount_what_if(star(t), 15)


def insights(t):
    return S.gap_drivers(star(t), MONTH, BEFORE)


@query("star_simulate_discount", "V4", sql(f"SELECT {WHAT_IF_COLUMNS} FROM {WHAT_IF} WHERE product_id = 'SKU-42'"))
def star_simulate_discount(t):
    S.create_simulation(t.spark, star(t))
    return t.spark.sql("SELECT * FROM simulate_discount('SKU-42', 15)")


@query("star_top_drivers", "V5", sql(f"{DRIVERS} SELECT rank, driver_type, dimension_value, revenue_current, revenue_prior, revenue_delta, contribution_to_gap_pct, insight FROM ins WHERE region = 'ASIA'"))
def star_top_drivers(t):
    return S.drivers_of(insights(t), "ASIA")


@query("star_explain_driver", "V6", sql(f"{DRIVERS} SELECT MAX(insight) AS explanation FROM ins WHERE region = 'ASIA' AND rank = 1"))
def star_explain_driver(t):
    return S.explanation(insights(t), "ASIA", 1)


@query(
    "star_concentration",
    "B27",
    sql(f""", p AS (SELECT product_id, CAST(SUM(net_sales) AS DOUBLE) AS revenue, ROUND(CAST(SUM(gross_margin) AS DOUBLE) * 100 / CAST(SUM(net_sales) AS DOUBLE), 1) AS m FROM f WHERE {NOW} GROUP BY 1),
    t5 AS (SELECT * FROM p ORDER BY revenue DESC, product_id LIMIT 5)
    SELECT ROUND((SELECT SUM(revenue) FROM t5) * 100 / total, 1) AS top_share_pct, ROUND(total - (SELECT MAX(revenue) FROM t5), 2) AS revenue_without_first,
      (SELECT arg_min(product_id, (m, product_id)) FROM t5) AS thinnest_margin_product FROM (SELECT CAST(SUM(CAST(revenue AS DECIMAL(18,4))) AS DOUBLE) AS total FROM p)"""),
)
def star_concentration(t):
    return S.concentration(star(t), MONTH)


@query(
    "star_cohorts",
    "B27",
    sql(f"""SELECT CASE WHEN year(signup_date) = 2001 THEN 'new' ELSE 'other' END AS cohort, customer_region, COUNT(DISTINCT customer_key) AS customers,
    ROUND(CAST(SUM(net_sales) AS DOUBLE) / COUNT(DISTINCT order_id), 2) AS avg_order_value FROM f WHERE {NOW} GROUP BY ALL"""),
)
def star_cohorts(t):
    return S.cohort_orders(star(t), MONTH)


@query("star_weekend_split", "B27", sql("SELECT is_weekend, CAST(SUM(net_sales) AS DOUBLE) AS revenue FROM f GROUP BY 1"))
def star_weekend_split(t):
    return S.weekend_split(star(t))


@query(
    "star_basket_size",
    "B27 B29",
    sql(f"""SELECT ROUND(CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT order_id), 2) AS lines_per_order, COUNT(DISTINCT customer_key) AS customers,
    CAST(SUM(net_sales) FILTER (discount_amount > 0) AS DOUBLE) AS discounted_revenue FROM f WHERE {NOW}"""),
)
def star_basket_size(t):
    return S.basket_size(star(t), MONTH)


@query(
    "star_vip_share",
    "B27 W10",
    sql(f"SELECT ROUND(CAST(COUNT(DISTINCT CASE WHEN loyalty_tier = 'VIP' THEN order_id END) AS DOUBLE) * 100 / CAST(COUNT(DISTINCT order_id) AS DOUBLE), 1) AS order_share_pct FROM f WHERE {NOW}"),
)
def star_vip_share(t):
    return S.order_share(star(t), MONTH, "VIP")


@query("star_brand_growth", "B27", sql(f"SELECT * FROM {growth_sql('category, brand')}"))
def star_brand_growth(t):
    return S.month_growth(star(t), MONTH, BEFORE, ["category", "brand"])


@query("star_best_quarter", "B27", sql("SELECT quarter, CAST(SUM(net_sales) AS DOUBLE) AS revenue FROM f GROUP BY 1 ORDER BY revenue DESC, quarter LIMIT 1"))
def star_best_quarter(t):
    return S.breakdown(star(t).rows("date"), ["quarter"]).orderBy(F.desc("revenue"), "quarter").limit(1).select("quarter", "revenue")


@query("star_vips_by_region", "B27", sql("SELECT customer_region, COUNT(*) AS vips FROM dim_customer WHERE loyalty_tier = 'VIP' GROUP BY 1"))
def star_vips_by_region(t):
    vips = star(t).customer.where("loyalty_tier = 'VIP'")
    return vips.groupBy("customer_region").agg(F.count(F.lit(1)).alias("vips"))


@query("star_signups", "B27 J4", sql("SELECT COUNT(*) AS signed_up, COUNT(*) FILTER (customer_key IN (SELECT customer_key FROM f WHERE " + NOW + ")) AS ordered_this_month FROM dim_customer WHERE year(signup_date) = 2001"))
def star_signups(t):
    s = star(t)
    new = s.customer.where(F.year("signup_date") == int(MONTH[:4])).select("customer_key")
    buyers = s.rows(month=MONTH).select("customer_key").distinct().withColumn("_bought", F.lit(1))
    return new.join(buyers, "customer_key", "left").agg(
        F.count(F.lit(1)).alias("signed_up"), F.count("_bought").alias("ordered_this_month")
    )
