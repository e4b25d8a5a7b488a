"""Versioned tables, sinks that keep rows single, constraints and expectations in the plans that write."""

import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import merge as M
from millrace.operators.quality import Constraint, Rule, enforce
from millrace.session import work_dir
from millrace.sources import guarded as G
from millrace.sources import storage
from millrace.sources.versioned import UnknownVersion, VersionedTable
from millrace.streaming import batches as B
from millrace.streaming import expectations as E
from millrace.streaming import ledger as L
from millrace.streaming import runner as R


def day(n):
    return F.lit(f"2024-01-{n + 1:02d}").cast("timestamp")


def ids(spark, *data):
    return spark.createDataFrame(list(data), "id int, v string")


@pytest.fixture()
def table(spark):
    t = VersionedTable.create(ids(spark, (1, "a"), (2, "b"), (3, "c")), work_dir(spark, "v"), ["id"], day(0), every=3)
    for n, (source, clauses) in enumerate(
        [
            (ids(spark, (1, "a1"), (4, "d")), M.UPSERT),
            (ids(spark, (1, "a2"), (2, "b")), [M.update()]),
            (ids(spark, (3, "")), [M.delete()]),
            (ids(spark, (5, "e")), M.UPSERT),
        ],
        1,
    ):
        assert t.merge(source, day(n), clauses) == n
    return t


STATES = {
    0: [(1, "a"), (2, "b"), (3, "c")],
    1: [(1, "a1"), (2, "b"), (3, "c"), (4, "d")],
    2: [(1, "a2"), (2, "b"), (3, "c"), (4, "d")],
    3: [(1, "a2"), (2, "b"), (4, "d")],
    4: [(1, "a2"), (2, "b"), (4, "d"), (5, "e")],
}


def test_states_come_from_the_last_snapshot(spark, table):
    for v, want in STATES.items():
        assert rows(table.state(v)) == want
    assert rows(table.state()) == STATES[4]
    assert rows(table.state(timestamp="2024-01-02 12:00:00")) == STATES[1]
    for bad in ({"version": 9}, {"timestamp": "2023-01-01"}):
        with pytest.raises(UnknownVersion):
            table.state(**bad)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = table.state(2)._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "snapshots/version=0" in plan and re.search(r"PartitionFilters: \[.*_commit_version#\d+L? >= 1\).*_commit_version#\d+L? <= 2", plan)
    at_snapshot = table.state(3)._jdf.queryExecution().toString()
    assert "snapshots/version=3" in at_snapshot and "/log" not in at_snapshot
    assert rows(table.history(), "_commit_version", "operation", "inserted", "updated", "deleted") == [
        (0, "INSERT", 3, 0, 0), (1, "MERGE", 1, 1, 0), (2, "UPDATE", 0, 2, 0), (3, "DELETE", 0, 0, 1), (4, "INSERT", 1, 0, 0)
    ]


def test_a_commit_that_broke_off_does_not_exist(spark, table):
    # rows of the next commit are there, its row in commits is not
    ids(spark, (9, "x")).selectExpr("*", "'insert' as _change_type", "timestamp'2024-02-01' as _commit_timestamp").write.parquet(f"{table.path}/log/_commit_version=5")
    assert rows(table.state()) == STATES[4] and table.feed(0).where("id = 9").isEmpty()
    assert table.merge(ids(spark, (6, "f")), day(5)) == 5
    assert rows(table.state()) == [*STATES[4], (6, "f")]


def test_changed_restored_undone(spark, table):
    assert rows(table.changed_keys(0, 4)) == [(1,), (3,), (4,), (5,)]
    assert rows(table.changed_keys(4, 0)) == rows(table.changed_keys(0, 4))
    assert rows(table.undo_where(0, "t.id = 1")) == [(1, "a"), (2, "b"), (4, "d"), (5, "e")]
    copy = table.apply_to(table.state(1), since=1)
    assert rows(copy) == STATES[4]
    table.restore(1, day(5))
    assert rows(table.state()) == STATES[1] and rows(table.state(4)) == STATES[4]


def test_expiry_can_break_off(spark, table, monkeypatch):
    import millrace.sources.versioned as V

    left = []

    def breaks(session, folder):
        if len(left) == 2:
            raise RuntimeError("lost")
        left.append(folder)
        storage.remove(session, folder)

    monkeypatch.setattr(V, "remove", breaks)
    with pytest.raises(RuntimeError):
        table.expire(2)
    assert rows(table.state(2)) == STATES[2] and rows(table.state()) == STATES[4]
    monkeypatch.setattr(V, "remove", storage.remove)
    table.expire(2)
    table.expire(2)
    assert rows(table.commits(), "version") == [(2,), (3,), (4,)]
    assert rows(table.log(), "id", "_commit_version") == [(1, 2), (2, 2), (3, 2), (3, 3), (4, 2), (5, 4)]
    for v in (2, 3, 4):
        assert rows(table.state(v)) == STATES[v]
    with pytest.raises(UnknownVersion):
        table.state(1)
    assert not storage.exists(spark, f"{table.path}/log/_commit_version=1")


def test_null_keys_are_refused(spark):
    with pytest.raises(Exception, match="NULL in key column"):
        VersionedTable.create(ids(spark, (None, "a")), work_dir(spark, "v"), ["id"], day(0))
    with pytest.raises(ValueError):
        path = VersionedTable.create(ids(spark, (1, "a")), work_dir(spark, "v"), ["id"], day(0)).path
        VersionedTable.create(ids(spark, (1, "a")), path, ["id"], day(0))
    empty = VersionedTable.create(ids(spark), work_dir(spark, "v"), ["id"], day(0))
    assert empty.state().isEmpty()
    empty.merge(ids(spark, (1, "a")), day(1))
    assert rows(empty.state()) == [(1, "a")]


# sinks


def files(spark, path, *parts):
    for p in parts:
        spark.createDataFrame(p, "id int, v int").coalesce(1).write.mode("append").parquet(path)


def load(spark, root, checkpoint, origin=True, **options):
    stream = R.stream_table(spark, f"{root}/in", **options)
    L.stream_to_ledger(L.with_origin(stream) if origin else stream, f"{root}/sink", f"{root}/{checkpoint}")


def test_lost_checkpoint_with_other_batch_borders(spark):
    root = work_dir(spark, "ledger")
    files(spark, f"{root}/in", [(1, 1)], [(2, 2), (2, 2)], [(3, 3)])
    load(spark, root, "a", maxFilesPerTrigger=1)
    files(spark, f"{root}/in", [(4, 4)])
    load(spark, root, "a")
    files(spark, f"{root}/in", [(5, 5)])
    load(spark, root, "b", maxFilesPerTrigger=2)
    load(spark, root, "c")
    assert rows(L.read_ledger(spark, f"{root}/sink"), "id") == [(1,), (2,), (2,), (3,), (4,), (5,)]


def test_rows_without_a_note_are_not_there(spark):
    root = work_dir(spark, "ledger")
    files(spark, f"{root}/in", [(1, 1)])
    load(spark, root, "a")
    # a batch that wrote its rows and broke off before its note; its replay is cut elsewhere
    spark.createDataFrame([(77, 7)], "id int, v int").write.parquet(f"{root}/sink/loads/load=1")
    assert rows(L.read_ledger(spark, f"{root}/sink"), "id") == [(1,)]
    files(spark, f"{root}/in", [(2, 2)])
    load(spark, root, "a")
    assert rows(L.read_ledger(spark, f"{root}/sink"), "id") == [(1,), (2,)]


def test_unknown_origin_is_refused_and_a_noted_batch_is_not_written_again(spark):
    root = work_dir(spark, "ledger")
    files(spark, f"{root}/in", [(1, 1)], [(2, 2)])
    load(spark, root, "a", origin=False)
    load(spark, root, "a", origin=False)
    assert L.read_ledger(spark, f"{root}/sink").count() == 2
    with pytest.raises(Exception, match="another checkpoint"):
        load(spark, root, "b", origin=False)
    batch = spark.read.parquet(f"{root}/in")
    L._write(batch, 0, f"{root}/sink", f"{root}/a", lambda r: r)
    assert L.read_ledger(spark, f"{root}/sink").count() == 2


def test_folded_upserts(spark):
    root, keys, order = work_dir(spark, "upserts"), ["id"], ["-v"]

    def run():
        stream = L.with_origin(R.stream_table(spark, f"{root}/in", maxFilesPerTrigger=1))
        L.upsert_to_ledger(stream, f"{root}/sink", keys, order, f"{root}/checkpoint")

    def now():
        return rows(L.read_upserts(spark, f"{root}/sink", keys, order), "id", "v")

    files(spark, f"{root}/in", [(1, 1), (1, 5)], [(1, 3), (2, 2)], [(3, 1)])
    run()
    want = [(1, 5), (2, 2), (3, 1)]
    assert now() == want
    # a fold that broke off: its base is there in part, nothing says it is whole
    spark.createDataFrame([(9, 9)], "id int, v int").write.parquet(f"{root}/sink/bases/load=2")
    assert now() == want
    assert L.compact(spark, f"{root}/sink", keys, order) == 2 and now() == want
    files(spark, f"{root}/in", [(2, 9), (4, 4)])
    run()
    want = [(1, 5), (2, 9), (3, 1), (4, 4)]
    assert now() == want
    plan = L.read_upserts(spark, f"{root}/sink", keys, order)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    scanned = plan._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "bases/load=2" in scanned and re.search(r"PartitionFilters: \[.*load#\d+.* >= 3", scanned)
    L.vacuum(spark, f"{root}/sink")
    assert not storage.exists(spark, f"{root}/sink/loads/load=0") and now() == want
    assert L.compact(spark, f"{root}/sink", keys, order) == 3 and now() == want
    assert L.compact(spark, f"{root}/sink", keys, order) == 3
    # a new checkpoint after the fold: every file is noted, so nothing changes
    L.upsert_to_ledger(L.with_origin(R.stream_table(spark, f"{root}/in")), f"{root}/sink", keys, order, f"{root}/other")
    assert now() == want


# expectations

RULES = [Rule("small", "v < 100", "drop"), Rule("even", "v % 2 = 0"), Rule("known", "id is not null", "fail")]


def test_counts_per_batch_and_a_failing_row(spark):
    root = work_dir(spark, "rules")
    files(spark, f"{root}/in", [(1, 1), (2, 200)])
    run = lambda: E.run_expected(R.stream_table(spark, f"{root}/in"), RULES, f"{root}/out", f"{root}/metrics", f"{root}/c")
    run()
    files(spark, f"{root}/in", [(3, 4), (4, None)])
    run()
    read = lambda: rows(B.read_batches(spark, f"{root}/metrics"), "batch_id", "rule", "on_fail", "passed", "failed")
    counts = [
        (0, "even", "warn", 1, 1), (0, "known", "fail", 2, 0), (0, "small", "drop", 1, 1),
        (1, "even", "warn", 1, 1), (1, "known", "fail", 2, 0), (1, "small", "drop", 1, 1),
    ]
    assert read() == counts
    files(spark, f"{root}/in", [(None, 500), (6, 6)])  # the bad row would be dropped as well: it still stops the batch
    with pytest.raises(Exception, match="violating rows: known"):
        run()
    assert rows(B.read_batches(spark, f"{root}/out"), "id") == [(1,), (3,)] and read() == counts


def test_counts_in_the_progress_of_a_query(spark):
    root = work_dir(spark, "rules")
    files(spark, f"{root}/in", [(1, 1), (2, 200)], [(3, 2)])
    q = R.run_append(E.expect_stream(R.stream_table(spark, f"{root}/in", maxFilesPerTrigger=1), RULES), f"{root}/out", f"{root}/c")
    got = E.progress_metrics(q, RULES)
    assert rows(got.groupBy("rule").agg(F.sum("passed"), F.sum("failed"))) == [("even", 2, 1), ("known", 3, 0), ("small", 2, 1)]
    assert got.select("batch_id").distinct().count() == 2


def test_enforced_rows(spark):
    df = ids(spark, (1, "a"), (2, None))
    assert rows(enforce(df, [Rule("v", "v is not null", "drop")]), "id") == [(1,)]
    with pytest.raises(Exception, match="violating rows: v"):
        enforce(df, [Rule("gone", "id < 2", "drop"), Rule("v", "v is not null", "fail")]).collect()
    assert enforce(df, [Rule("v", "v is not null")]).count() == 2


# constraints


def test_constraints_hold_for_every_write(spark):
    path = work_dir(spark, "constrained")
    ids(spark, (1, "a"), (2, "b")).write.parquet(path)
    with pytest.raises(Exception, match="violating rows"):
        G.add_constraint(spark, path, Constraint.check("big", "id > 1"))
    G.add_constraint(spark, path, Constraint.check("positive", "id > 0"))
    G.add_constraint(spark, path, Constraint.not_null("v"))
    assert rows(G.listed(spark, path), "name") == [("positive",), ("v_not_null",)]
    for bad in ((3, None), (0, "x"), (None, "x")):
        with pytest.raises(Exception, match="violating rows"):
            G.append(spark.createDataFrame([(9, "ok"), bad], "id int, v string").repartition(2), path)
        with pytest.raises(Exception, match="violating rows"):
            G.overwrite(ids(spark, (9, "ok"), bad), path)
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "b")]
    G.append(ids(spark, (3, "c")), path)
    with pytest.raises(ValueError):
        G.append(ids(spark, (3, "c")).withColumn("more", F.lit(1)), path)
    G.overwrite(ids(spark, (7, "g")), path)
    assert rows(spark.read.parquet(path)) == [(7, "g")] and len(G.constraints(spark, path)) == 2
    G.drop_constraint(spark, path, "v_not_null")
    G.append(ids(spark, (8, None)), path)
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(KeyError):
        G.drop_constraint(spark, path, "v_not_null")
    G.add_constraint(spark, path, Constraint.check("positive", "id > -5", null_passes=True))
    G.append(ids(spark, (-1, "n"), (None, "n")), path)
    assert spark.read.parquet(path).count() == 4


def test_the_assertion_is_part_of_the_write(spark):
    path = work_dir(spark, "constrained")
    ids(spark, (1, "a")).write.parquet(path)
    G.add_constraint(spark, path, Constraint.check("positive", "id > 0"))
    plan = G.checked(spark.read.parquet(path), path)._jdf.queryExecution().toString()
    assert "raise_error" in plan and plan.count("Scan parquet") <= 2 and "Aggregate" not in plan


def test_constrained_partitions(spark):
    path = work_dir(spark, "constrained")
    df = spark.createDataFrame([(1, "x", 1), (2, "x", 2), (3, "y", 3)], "id int, p string, n int")
    df.write.partitionBy("p").parquet(path)
    G.add_constraint(spark, path, Constraint.check("positive", "n > 0"))
    change = spark.createDataFrame([(1, "x", 9), (4, "y", -4)], "id int, p string, n int")
    with pytest.raises(Exception, match="violating rows"):
        G.merge_into(path, change, ["id", "p"], ["p"])
    with pytest.raises(Exception, match="violating rows"):
        G.replace_partitions(change.select("id", "n", "p"), path, ["p"])
    assert rows(spark.read.parquet(path), "id", "p", "n") == [(1, "x", 1), (2, "x", 2), (3, "y", 3)]
    G.merge_into(path, change.where("n > 0"), ["id", "p"], ["p"])
    assert rows(spark.read.parquet(path), "id", "p", "n") == [(1, "x", 9), (2, "x", 2), (3, "y", 3)]
