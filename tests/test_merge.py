import pytest
from conftest import rows

from millrace.operators import merge as M

SCHEMA = "id string, amount double, status string, at int"


@pytest.fixture(scope="module")
def pair(spark):
    target = spark.createDataFrame(
        [("a", 1.0, "open", 5), ("b", 2.0, "open", 5), ("c", 3.0, "open", 5), (None, 9.0, "open", 5)], SCHEMA
    )
    source = spark.createDataFrame(
        [("a", 10.0, "done", 6), ("b", 20.0, "done", 4), ("c", 30.0, "cancelled", 9), ("d", 40.0, "new", 1), (None, 50.0, "new", 1)],
        SCHEMA,
    )
    return target, source


CLAUSES = {
    "upsert": M.UPSERT,
    "newer": (M.update(when="s.at > t.at"), M.insert()),
    "delete first": (M.delete("s.status = 'cancelled'"), M.update(when="s.at > t.at"), M.insert()),
    "conditional insert": (M.update(set={"amount": "t.amount + s.amount"}), M.insert(when="s.amount > 45")),
    "null condition": (M.update(when="cast(null as boolean)"), M.insert()),
}


@pytest.mark.parametrize("name", CLAUSES)
def test_keyed_and_general_plans_agree(pair, name):
    a = M.merge(*pair, ["id"], CLAUSES[name], keyed=True)
    b = M.merge(*pair, ["id"], CLAUSES[name])
    assert rows(a) == rows(b)


def test_clauses_in_order_and_null_keys_insert(pair):
    out = rows(M.merge(*pair, ["id"], CLAUSES["delete first"]), "id", "amount")
    assert out == [("a", 10.0), ("b", 2.0), ("d", 40.0), (None, 50.0), (None, 9.0)]


def test_only_listed_columns_change(pair):
    clauses = [M.update(set={"status": "'seen'"}), M.insert(values={"id": "s.id", "amount": "s.amount"})]
    out = {r.id: r for r in M.merge(*pair, ["id"], clauses).where("id is not null").collect()}
    assert (out["a"].amount, out["a"].status, out["a"].at) == (1.0, "seen", 5)
    assert (out["d"].amount, out["d"].status, out["d"].at) == (40.0, None, None)


def test_several_source_rows_for_one_target_row(spark, pair):
    target, source = pair
    twice = source.union(source.where("id = 'a'").selectExpr("id", "amount + 1", "status", "at + 1"))
    with pytest.raises(M.MergeCardinalityError):
        M.merge(target, twice, ["id"])
    out = rows(M.merge(target, twice, ["id"], dedupe=["-at"]).where("id = 'a'"), "amount")
    assert out == [(11.0,)]
    # duplicates of a key the target lacks match no target row
    new = source.where("id = 'd'")
    assert M.merge(target, new.union(new), ["id"]).where("id = 'd'").count() == 2


def test_schema_evolution(spark, pair):
    target, source = pair
    wide = source.selectExpr("*", "'x' as extra")
    out = {r.id: r.extra for r in M.merge(target, wide, ["id"], evolve=True).where("id is not null").collect()}
    assert out == {"a": "x", "b": "x", "c": "x", "d": "x"}
    only_new = M.merge(target, wide.where("id = 'd'"), ["id"], evolve=True)
    assert {r.id: r.extra for r in only_new.collect()}["a"] is None
    assert "extra" not in M.merge(target, wide, ["id"]).columns


def test_merge_again_changes_nothing(pair):
    target, source = pair
    source = source.where("id is not null")
    once = M.merge(target, source, ["id"])
    assert rows(M.merge(once, source, ["id"])) == rows(once)


def test_update_delete_replace(spark, pair):
    target, _ = pair
    out = M.update_where(target, "amount > 2", {"amount": "amount * 2", "status": "concat(status, amount)"})
    assert rows(out, "amount", "status")[0] == (1.0, "open") and (6.0, "open3.0") in rows(out, "amount", "status")
    assert M.delete_where(target, "id = 'a'").count() == 3  # the NULL id stays
    with pytest.raises(ValueError):
        M.replace_where(target, target, "status = 'done'")
    kept = M.replace_where(target, target.where("id = 'a'"), "status = 'open'")
    assert rows(kept, "id") == [("a",)]
