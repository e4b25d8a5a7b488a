import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.session import work_dir
from millrace.streaming import batches as B
from millrace.streaming import checkpoints as C
from millrace.streaming import joins as J
from millrace.streaming import runner as R
from millrace.streaming import windows as W


def put(spark, path, data):
    df = spark.createDataFrame(data, "id int, user string, at string, v double").withColumn("ts", F.to_timestamp("at")).drop("at")
    df.coalesce(1).write.mode("append").parquet(path)


FIRST = [(1, "a", "2024-01-01 09:01:00", 1.0), (2, "a", "2024-01-01 09:03:00", 2.0), (3, "b", "2024-01-01 09:26:00", 3.0)]
LATE = [(4, "a", "2024-01-01 09:04:00", 50.0), (5, "b", "2024-01-01 09:50:00", 4.0)]


def test_mode_rules():
    R.check_mode("append", aggregated=True, watermarked=True)
    for mode, aggregated, watermarked in (("complete", False, False), ("append", True, False), ("often", False, False)):
        with pytest.raises(ValueError):
            R.check_mode(mode, aggregated, watermarked)


def test_late_rows_are_dropped_after_the_watermark(spark):
    root = work_dir(spark, "t")
    for data in (FIRST, LATE):
        put(spark, f"{root}/in", data)
        counts = W.window_agg(R.stream_table(spark, f"{root}/in"), "ts", "5 minutes", {"n": F.count(F.lit(1)), "v": F.sum("v")}, delay="10 minutes")
        R.run_append(counts, f"{root}/out", f"{root}/checkpoint")
    got = rows(spark.read.parquet(f"{root}/out").selectExpr("date_format(window_start, 'HH:mm') as w", "n", "v"))
    # 09:00 closed in the first run, so the row of 09:04 came too late; 09:50 is open
    assert got == [("09:00", 2, 3.0), ("09:25", 1, 3.0)]


def test_session_gap_may_be_reached(spark):
    path = work_dir(spark, "t")
    put(spark, path, [(1, "a", "2024-01-01 09:00:00", 1.0), (2, "a", "2024-01-01 09:10:00", 1.0), (3, "a", "2024-01-01 09:20:01", 1.0)])
    out = work_dir(spark, "t")
    R.run_complete(W.session_agg(R.stream_table(spark, path), "ts", "10 minutes", ["user"], {"n": F.count(F.lit(1))}), out, work_dir(spark, "c"))
    assert rows(spark.read.parquet(out), "n") == [(1,), (2,)]
    with pytest.raises(ValueError):
        W.session_agg(R.stream_table(spark, path), "ts", "10 minutes", [], {"n": F.count(F.lit(1))})


def test_retry_is_dropped_within_the_window(spark):
    path = work_dir(spark, "t")
    put(spark, path, [(1, "a", "2024-01-01 09:00:00", 1.0), (1, "a", "2024-01-01 09:01:00", 1.0), (2, "a", "2024-01-01 09:01:00", 1.0)])
    out = work_dir(spark, "t")
    R.run_append(W.stream_dedup_within(R.stream_table(spark, path), ["id"], "ts", "10 minutes"), out, work_dir(spark, "c"))
    assert rows(spark.read.parquet(out), "id") == [(1,), (2,)]


def test_lost_checkpoint_doubles_a_plain_append_but_not_a_batch_sink(spark):
    root = work_dir(spark, "t")
    put(spark, f"{root}/in", FIRST)
    stream = R.stream_table(spark, f"{root}/in")
    for n in (1, 2):
        B.stream_once(stream, f"{root}/once", R.checkpoint_path(root, f"once-{n}"))
    assert B.read_batches(spark, f"{root}/once").count() == 3
    target = spark.createDataFrame([], stream.schema)
    target.write.parquet(f"{root}/plain")
    for n in (1, 2):
        R.run_batches(stream, lambda b, i: b.write.mode("append").parquet(f"{root}/plain"), R.checkpoint_path(root, f"plain-{n}"))
    assert spark.read.parquet(f"{root}/plain").count() == 6


def test_resume_progress_and_checkpoint(spark):
    root = work_dir(spark, "t")
    put(spark, f"{root}/in", FIRST)
    q = R.run_append(R.stream_table(spark, f"{root}/in"), f"{root}/out", f"{root}/c", name="copy")
    assert rows(C.progress_row(spark, q), "name", "input_rows") == [("copy", 3)]
    put(spark, f"{root}/in", LATE)
    R.run_append(R.stream_table(spark, f"{root}/in"), f"{root}/out", f"{root}/c")
    assert spark.read.parquet(f"{root}/out").count() == 5
    assert C.checkpoint_summary(spark, f"{root}/c").first().asDict() == {
        "planned_batches": 2, "last_planned": 1, "committed_batches": 2, "last_committed": 1, "clean": True
    }
    assert C.active_queries(spark).count() == 0


def test_static_joins_refuse_what_cannot_end(spark):
    path = work_dir(spark, "t")
    put(spark, path, FIRST)
    dim = spark.createDataFrame([("a", "x")], "user string, tier string")
    for how in ("right", "right_outer", "full_outer"):
        with pytest.raises(ValueError):
            J.stream_enrich(R.stream_table(spark, path), dim, "user", how)


def test_stream_join_lint(spark):
    assert J.lint_stream_join("5 minutes", ("10 minutes", "10 minutes")) == []
    assert len(J.lint_stream_join(None, (None, "10 minutes"))) == 2
    with pytest.raises(ValueError):
        J.interval_join(None, None, ("a", "b"), ("x", "y"), None, how="left_outer")


def test_interval_join_bounds_and_unmatched(spark):
    a, b = work_dir(spark, "t"), work_dir(spark, "t")
    put(spark, a, [(1, "o", "2024-01-01 09:00:00", 1.0), (2, "o", "2024-01-01 09:00:00", 1.0), (3, "o", "2024-01-01 09:00:00", 1.0), (9, "o", "2024-01-01 12:00:00", 1.0)])
    put(spark, b, [(1, "s", "2024-01-01 09:05:00", 1.0), (2, "s", "2024-01-01 09:05:01", 1.0), (8, "s", "2024-01-01 12:00:00", 1.0)])
    left = R.stream_table(spark, a).selectExpr("id", "ts")
    right = R.stream_table(spark, b).selectExpr("id as rid", "ts as rts")
    got = {}
    for how in ("inner", "left_outer", "right_outer"):
        out = work_dir(spark, "t")
        joined = J.interval_join(left, right, ("id", "rid"), ("ts", "rts"), "5 minutes", how=how)
        R.run_append(joined, out, work_dir(spark, "c"))
        back = spark.read.schema(joined.schema).parquet(out)
        assert J.out_of_bounds(back, "ts", "rts", "5 minutes").isEmpty()
        got[how] = rows(back, "id", "rid")
    assert got == {
        "inner": [(1, 1)],
        "left_outer": [(1, 1), (2, None), (3, None)],
        "right_outer": [(1, 1), (None, 2)],
    }


def at_minute(m):
    return f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00"


def spread_events(spark, rows=400):
    """Events of one day, two minutes apart, in no order of time; the last row has no time."""
    data = [(i, f"u{i % 5}", at_minute((i * 147 % rows) * 2), 1.0) for i in range(rows)] + [(rows, "u0", None, 1.0)]
    return spark.createDataFrame(data, "id int, user string, at string, v double").repartition(3, "id").withColumn("ts", F.to_timestamp("at")).drop("at")


def test_replay_holds_a_slice_and_gives_the_rows_of_one_batch(spark):
    events = spread_events(spark)
    results, held = [], []
    for slices in (1, 8):
        rule = lambda s: W.amount_rule(s, "user", "ts", "v", limit=2)
        table, query = R.replay_append([(events, "ts")], rule, work_dir(spark, "t"), slices)
        results.append(rows(table.withColumns({c: F.col(c).cast("string") for c in ("window_start", "window_end")})))
        held.append(C.state_rows(spark, [query]).agg(F.max("rows_in_state"), F.sum("rows_late")).first())
    assert len(results[0]) > 500 and results[0] == results[1]
    assert held[1][0] < held[0][0] / 2 and held[1][1] == 0


def test_replayed_outer_join_matches_one_batch(spark):
    left = spread_events(spark).select("id", "ts")
    # the right side ends later, and some rows match none; both newest rows are in the last slice
    right = spread_events(spark).where("id % 3 > 0").selectExpr("id as rid", "ts + interval 4 minutes as rts").unionByName(
        spark.createDataFrame([(-1, at_minute(1000))], "rid int, at string").selectExpr("rid", "to_timestamp(at) as rts"))
    results, held = [], []
    for slices in (1, 6):
        join = lambda a, b: J.interval_join(a, b, ("id", "rid"), ("ts", "rts"), "5 minutes", how="left_outer")
        table, query = R.replay_append([(left, "ts"), (right, "rts")], join, work_dir(spark, "t"), slices)
        results.append(rows(table.selectExpr("id", "cast(ts as string)", "rid", "cast(rts as string)")))
        held.append(C.state_rows(spark, [query]).agg(F.max("rows_in_state")).first()[0])
    assert results[0] == results[1] and sum(r[2] is None for r in results[0]) > 100 and sum(r[2] is not None for r in results[0]) > 200
    assert held[1] < held[0] / 2


def test_replay_stages_little_and_leaves_only_its_result(spark, tmp_path):
    lines = spread_events(spark).select(F.to_json(F.struct("id", "user", "ts")).alias("value"), "ts")
    kept = ["spark.sql.streaming.minBatchesToRetain", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"]
    before, inside, staged = [spark.conf.get(k) for k in kept], [], []

    def build(stream):
        inside.extend(spark.conf.get(k) for k in kept)
        staged.extend(tmp_path.rglob("t/staged-0/*/part-*"))
        return stream

    table, _ = R.replay_append([(lines, "ts")], build, str(tmp_path / "t"), 4, "text")
    assert staged and all(p.suffix == ".gz" for p in staged)
    assert inside == ["2", "true"] and [spark.conf.get(k) for k in kept] == before
    assert not list(tmp_path.rglob("t/staged-0/*/part-*")) and not list(tmp_path.rglob("t/in-0/*/part-*"))
    assert rows(table) == rows(lines.select("value")) and table.count() == 401


def test_replay_of_an_empty_table(spark):
    empty = spread_events(spark).where("id < 0")
    for slices in (1, 4):
        table, _ = R.replay_append([(empty, "ts")], lambda s: W.stream_dedup_within(s, ["id"], "ts", "1 minute"), work_dir(spark, "t"), slices)
        assert table.columns == empty.columns and table.count() == 0
