"""Registered queries against DuckDB on the smallest tables; check.py runs all of them."""

import pytest

import __spark_entry__ as entry
from check import compare, connect

SOME = """
regional_monthly_rank join_chain_best_line join_linked_pairs state_diff agg_cube agg_collect agg_salted
rank_customers gap_sessions cumulative_share top_k except_both_ways parse_json_text order_items_summary
merge_delete_update_insert scd2_apply apply_changes_history feed_apply restore_version quality_report
rescue_json_lines load_once ingest_evolving zorder_layout window_closed_only stream_stream_left
batch_upsert_and_quarantine layer_gold_increment payments_risk_score sales_product_tiers star_gap_drivers
star_simulate_discount
""".split()


@pytest.mark.parametrize("name", SOME)
def test_query_matches_sql(spark, sf, name):
    n, problem = compare(entry.queries()[name](spark, sf), connect(sf), entry.oracle_sql()[name])
    assert problem is None
    assert n > 0


def test_entry_and_registry(spark):
    assert entry.entry(spark).columns == ["region", "month", "orders", "revenue", "revenue_rank"]
    without = set(entry.REGISTRY) - set(entry.oracle_sql())
    assert without == {"sample_preview", "activity_summary_approximate"}
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_sample_is_repeatable(spark, sf):
    run = entry.queries()["sample_preview"]
    a, b = run(spark, sf), run(spark, sf)
    assert a.exceptAll(b).isEmpty() and 0 < a.count() < spark.read.parquet(f"{sf}/orders.parquet").count()


def test_approximate_distinct_is_close(spark, sf):
    exact = {r.user_id: r.distinct_products_purchased for r in entry.queries()["activity_customer_summary"](spark, sf).collect()}
    close = {r.user_id: r.distinct_products_purchased for r in entry.queries()["activity_summary_approximate"](spark, sf).collect()}
    assert exact.keys() == close.keys()
    # 5 % is the standard error of an estimate, not a bound for each: single groups may be further off
    assert sum(abs(close[k] - exact[k]) for k in exact) <= 0.05 * sum(exact.values())
