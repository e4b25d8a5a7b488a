import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import changes as C
from millrace.operators import merge as M
from millrace.operators import scd as S

DAY = "2024-01-01"


@pytest.fixture(scope="module")
def dim(spark):
    first = spark.createDataFrame([(1, "A", None, "x"), (2, "B", "b@", "y"), (3, "C", "c@", "z")], "id int, name string, email string, tier string")
    return S.scd2_init(first, F.lit(DAY))


@pytest.fixture(scope="module")
def update(spark):
    return spark.createDataFrame([(1, "A", "a@", "x"), (2, "B", "b@", "y"), (4, "D", None, "w")], "id int, name string, email string, tier string")


def test_scd2_null_to_value_unchanged_absent_new(dim, update):
    out = S.scd2(dim, update, ["id"], ["name", "email", "tier"], F.lit("2024-02-01"))
    got = rows(out.selectExpr("id", "email", "is_current", "version", "string(effective_end_date) as e"))
    assert got == [
        (1, "a@", True, 2, S.OPEN_END), (1, None, False, 1, "2024-02-01"), (2, "b@", True, 1, S.OPEN_END),
        (3, "c@", True, 1, S.OPEN_END), (4, None, True, 1, S.OPEN_END),
    ]
    again = S.scd2(out, update, ["id"], ["name", "email", "tier"], F.lit("2024-03-01"))
    assert rows(again) == rows(out)
    assert rows(S.version_counts(out, ["id"])) == [(1, 2)]
    assert S.current(out).count() == 4


def changes_of(spark):
    data = [
        ("k", 1, "a", "p1"), ("k", 2, None, "p2"), ("k", 3, "a", "p3"), ("k", 4, "b", None), ("k", 5, "a", "p5"),
        ("m", 9, None, None), ("m", 7, "q", "z"),
    ]
    return spark.createDataFrame(data, "key string, seq int, tracked string, free string")


def test_apply_changes_history(spark):
    out = S.apply_changes(changes_of(spark), ["key"], "seq", track=["tracked"], ignore_nulls=True)
    assert rows(out) == [
        ("k", "a", "p3", 1, 4), ("k", "a", "p5", 5, None), ("k", "b", "p3", 4, 5), ("m", "q", "z", 7, None)
    ]
    with_nulls = S.apply_changes(changes_of(spark), ["key"], "seq", track=["tracked"], exclude=["free"])
    assert with_nulls.where("key = 'k'").count() == 5
    assert "free" not in with_nulls.columns


def test_apply_changes_split_over_tasks(spark):
    many = spark.range(600).selectExpr(
        "if(id % 3 = 0, 0, id % 50) as key", "id as seq", "if(id % 4 = 0, null, cast(id % 5 as string)) as tracked", "id as free"
    )
    args = dict(keys=["key"], seq="seq", track=["tracked"], ignore_nulls=True)
    assert rows(S.apply_changes(many, rows_per_task=40, **args)) == rows(S.apply_changes(many, **args))


def test_apply_changes_latest(spark):
    assert rows(S.apply_changes(changes_of(spark), ["key"], "seq", scd=1)) == [("k", "a", "p5", 5), ("m", None, None, 9)]
    out = S.apply_changes(changes_of(spark), ["key"], "seq", scd=1, ignore_nulls=True)
    assert rows(out) == [("k", "a", "p5", 5), ("m", "q", "z", 9)]


@pytest.fixture(scope="module")
def log(spark):
    def at(n):
        return F.lit(f"2024-01-0{n}").cast("timestamp")

    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    now, out = base, C.baseline(base, 0, at(1))
    for n, (data, clauses) in enumerate(
        [
            ([(1, "a1"), (4, "d")], M.UPSERT),
            ([(1, "a2"), (2, "b")], [M.update()]),
            ([(3, "")], [M.delete()]),
        ],
        start=1,
    ):
        now, feed = C.commit(now, spark.createDataFrame(data, "id int, v string"), ["id"], n, at(n + 1), clauses)
        out = out.unionByName(feed)
    return out


def test_commit_feed(log):
    v1 = rows(C.changes(log, 1, 1), "_change_type", "id", "v")
    assert v1 == [("insert", 4, "d"), ("update_postimage", 1, "a1"), ("update_preimage", 1, "a")]
    assert "_commit_timestamp" in log.columns
    assert rows(C.changes(log, 3, types=["delete"]), "id", "v") == [(3, "c")]


def test_states(log):
    assert rows(C.as_of(log, ["id"], version=0)) == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(C.as_of(log, ["id"], timestamp="2024-01-02 10:00:00")) == [(1, "a1"), (2, "b"), (3, "c"), (4, "d")]
    assert rows(C.as_of(log, ["id"])) == [(1, "a2"), (2, "b"), (4, "d")]
    assert rows(C.changed_keys(log, ["id"], 0, 3)) == [(1,), (3,), (4,)]
    assert rows(C.first_seen(log, ["id"], "v like 'a%' and v <> 'a'")) == [(1, 1)]


def test_apply_feed_with_several_changes_per_key(log):
    start = C.as_of(log, ["id"], version=0)
    done = C.apply_feed(start, C.changes(log, 1), ["id"])
    assert rows(done) == rows(C.as_of(log, ["id"]))
    assert rows(C.apply_feed(done, C.changes(log, 1), ["id"])) == rows(done)


def test_restore_undo_expire(log):
    back = C.restore(log, ["id"], 0, 4, F.lit("2024-01-09").cast("timestamp"))
    assert rows(C.as_of(log.unionByName(back), ["id"])) == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(C.undo_where(log, ["id"], 0, "t.id = 1")) == [(1, "a"), (2, "b"), (4, "d")]
    short = C.expire(log, ["id"], 2)
    assert rows(C.as_of(short, ["id"])) == rows(C.as_of(log, ["id"]))
    assert rows(C.as_of(short, ["id"], version=2)) == rows(C.as_of(log, ["id"], version=2))
    assert short.where("_commit_version < 2").isEmpty()


def test_history_operations(log):
    assert rows(C.history(log), "_commit_version", "operation", "inserted", "updated", "deleted") == [
        (0, "INSERT", 3, 0, 0), (1, "MERGE", 1, 1, 0), (2, "UPDATE", 0, 2, 0), (3, "DELETE", 0, 0, 1)
    ]


def test_history_refuses_equal_sequence_numbers(spark):
    twice = spark.createDataFrame([("k", 1, "a"), ("k", 1, "b")], "key string, seq int, tracked string")
    with pytest.raises(Exception, match="two changes of a key"):
        S.apply_changes(twice, ["key"], "seq").collect()
    assert S.apply_changes(twice, ["key"], "seq", tie=["tracked"]).count() == 2


def test_change_log_refuses_null_keys(spark):
    state = spark.createDataFrame([(None, 1), (None, 2)], "key string, v int")
    log = C.baseline(state, 0, F.lit("2024-01-01").cast("timestamp"))
    with pytest.raises(Exception, match="NULL in key column"):
        C.as_of(log, ["key"]).collect()
    with pytest.raises(Exception, match="NULL in key column"):
        C.diff(state, state, ["key"], 1, F.lit("2024-01-01").cast("timestamp")).collect()
