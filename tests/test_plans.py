"""What the physical plans must show."""

import contextlib
import io

import pytest

import __spark_entry__ as entry


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def query(spark, sf, name):
    return plan(entry.queries()[name](spark, sf))


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = query(spark, sf, "read_parquet_pruned")
    assert "PushedFilters: [IsNotNull(l_quantity), IsNotNull(l_returnflag), GreaterThan(l_quantity,45.0)" in text
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_returnflag:string>" in text
    assert "PartitionFilters: [isnotnull(l_returnflag" in query(spark, sf, "write_partitioned")


@pytest.mark.parametrize("name", ["latest_per_key", "top_two_per_key", "join_chain_best_line", "qualify_rank", "merge_latest_per_customer"])
def test_groups_are_cut_before_the_shuffle(spark, sf, name):
    text = query(spark, sf, name)
    assert "Partial" in text and "WindowGroupLimit" in text


@pytest.mark.parametrize("name", ["join_star", "scalar_beside_scalar", "star_region_pacing", "merge_upsert", "expire_history", "star_concentration"])
def test_no_products_of_rows(spark, sf, name):
    text = query(spark, sf, name)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_small_sides_are_broadcast(spark, sf):
    assert "BroadcastHashJoin" in query(spark, sf, "join_broadcast_small")
    assert "BroadcastHashJoin" in query(spark, sf, "join_star")


def test_keyed_merge_joins_once(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = query(spark, sf, "merge_upsert").split("== Physical Plan ==")[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tree = text.split("\n\n\n")[0]
    assert tree.count("Join FullOuter") == 1 and tree.count("Exchange") == 2


def test_top_k_is_not_a_global_sort(spark, sf):
    assert "TakeOrderedAndProject" in query(spark, sf, "top_k")
