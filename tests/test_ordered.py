"""The split path of the ordered operators against plain windows."""

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import windows as W
from millrace.operators.ordered import Ordered


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows, another NULL key a tenth; values repeat and go missing."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 200).alias("k"),
        F.expr("id % 97").alias("day"),
        "id",
        F.expr("if(id % 7 < 5, null, cast(id % 50 as decimal(10,2)))").alias("v"),
    )
    return df


def plain(keys, order):
    from millrace.operators.ordered import ordering

    return Window.partitionBy(*(keys or [F.lit(1)])).orderBy(*ordering(order))


CASES = [(["k"], ["day", "id"]), (["k"], ["-day", "id"]), ([], ["day", "-id"])]


@pytest.mark.parametrize("keys,order", CASES)
def test_split_equals_plain_window(skewed, keys, order):
    w = plain(keys, order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = (
        skewed.withColumn("rn", F.row_number().over(w).cast("bigint"))
        .withColumn("run", F.sum("v").over(upto))
        .withColumn("prev", F.lag("v").over(w))
        .withColumn("nt", F.ntile(7).over(w))
        .withColumn("v", F.last("v", ignorenulls=True).over(upto))
    )
    got = Ordered(skewed, keys, order, rows_per_task=100)
    assert got.split
    got = (
        got.row_number("rn").running_sum("run", F.col("v")).previous("prev", F.col("v")).ntile("nt", 7)
        .fill_forward(["v"]).result()
    )
    cols = ["k", "day", "id", "v", "rn", "run", "prev", "nt"]
    assert rows(got, *cols) == rows(want, *cols)


@pytest.mark.parametrize("keys", [["k"], []])
def test_rank_with_heavy_ties(skewed, keys):
    w = plain(keys, ["-day"])
    want = skewed.withColumn("r", F.rank().over(w).cast("bigint")).withColumn("d", F.dense_rank().over(w).cast("bigint"))
    got = W.rank_by(skewed, ["-day"], keys, rank="r", dense="d", rows_per_task=50)
    assert rows(got, "id", "r", "d") == rows(want, "id", "r", "d")


def test_rolling_with_halo(skewed):
    w = plain(["k"], ["day", "id"]).rowsBetween(-6, 0)
    want = skewed.withColumn("s", F.sum("v").over(w)).withColumn("n", F.count(F.lit(1)).over(w))
    got = W.rolling(
        skewed, ["k"], ["day", "id"], 7, {"s": F.sum("v"), "n": F.count(F.lit(1))}, rows_per_task=40
    )
    assert rows(got, "id", "s", "n") == rows(want, "id", "s", "n")


def test_sessions_split_equals_plain(spark):
    events = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("u"),
        "id",
        F.timestamp_seconds((F.col("id") * 7919) % 400_000).alias("ts"),
    )
    a = W.sessionize(events, ["u"], "ts", 1800, ["ts", "id"], "s")
    b = W.sessionize(events, ["u"], "ts", 1800, ["ts", "id"], "s", rows_per_task=60)
    assert rows(a, "id", "s") == rows(b, "id", "s")


def test_shares_and_ends(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 30), (None, 1, 5)], "k string, o int, v int")
    assert rows(W.share_of(df, ["k"], F.col("v"), "p"), "k", "p") == [("a", 25.0), ("a", 75.0), (None, 100.0)]
    assert rows(W.cumulative_share(df, ["k"], ["o"], F.col("v"), "c"), "k", "c") == [
        ("a", 100.0), ("a", 25.0), (None, 100.0)
    ]
    assert rows(W.first_last(df, ["k"], ["o"], ["v"]), "k", "first_v", "last_v") == [
        ("a", 10, 30), ("a", 10, 30), (None, 5, 5)
    ]


def test_session_gap_must_be_exceeded(spark):
    df = spark.createDataFrame(
        [("u", 1, "2024-01-01 10:00:00"), ("u", 2, "2024-01-01 10:30:00"), ("u", 3, "2024-01-01 11:00:01")],
        "u string, id int, t string",
    ).withColumn("ts", F.to_timestamp("t"))
    assert rows(W.sessionize(df, ["u"], "ts", 1800, ["ts"], "s"), "id", "s") == [(1, 1), (2, 1), (3, 2)]


def test_rank_contract(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate([5, 4, 4, 3, 3, 1])], "id int, n int")
    out = rows(W.rank_by(df, ["-n"], rank="r", dense="d"), "id", "r", "d")
    assert [r for _, r, _ in out] == [1, 2, 2, 4, 4, 6]
    assert [d for _, _, d in out] == [1, 2, 2, 3, 3, 4]


def test_collect_chunks_keeps_every_row(spark):
    from millrace.operators.aggregates import collect_chunks

    df = spark.range(25).select(F.lit("k").alias("k"), "id")
    out = rows(collect_chunks(df, ["k"], ["id"], F.col("id"), "ids", chunk_rows=10, rows_per_task=6), "chunk", "ids")
    assert [len(x[1]) for x in out] == [10, 10, 5]
    assert sum((x[1] for x in out), []) == list(range(25))


def test_nothing_is_counted_and_no_task_takes_all_rows(spark, skewed, monkeypatch):
    """One layout and one join for several columns; the rows of a window are parted by segment also without keys."""
    from millrace.operators import ordered

    laid = []
    monkeypatch.setattr(ordered, "pin", lambda df, label: laid.append(label) or df)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    out = Ordered(skewed, [], ["day", "id"]).row_number("rn").previous("prev", F.col("v")).ntile("nt", 7).result()
    assert laid == ["segments"] and spark.sparkContext.statusTracker().getJobIdsForGroup(None) == jobs
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") <= 1 and "rangepartitioning(day#" in plan
    over_rows = [line for line in plan.splitlines() if "Window [row_number()" in line or "lag(" in line]
    assert over_rows and all("_segment#" in line for line in over_rows)


def test_columns_that_build_on_each_other(skewed):
    w = plain(["k"], ["day", "id"])
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumn("old", F.sum("v").over(upto)).withColumn("v", F.last("v", ignorenulls=True).over(upto)).withColumn("new", F.sum("v").over(upto))
    got = Ordered(skewed, ["k"], ["day", "id"], rows_per_task=100).running_sum("old", F.col("v")).fill_forward(["v"]).running_sum("new", F.col("v")).result()
    assert rows(got, "id", "v", "old", "new") == rows(want, "id", "v", "old", "new")
    by_bytes = Ordered(skewed, ["k"], ["day", "id"]).running_sum("old", F.col("v")).fill_forward(["v"]).running_sum("new", F.col("v")).result()
    assert rows(by_bytes, "id", "v", "old", "new") == rows(want, "id", "v", "old", "new")
