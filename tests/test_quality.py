import pytest
from conftest import rows

from millrace.operators import quality as Q
from millrace.streaming.batches import route


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None), (None, 7.0)], "id int, amount double")


def test_constraints(spark, df):
    positive = Q.Constraint.check("positive", "amount > 0")
    assert Q.violations(df, [positive, Q.Constraint.not_null("id")]).first().asDict() == {"positive": 2, "id_not_null": 1}
    relaxed = Q.Constraint.check("positive", "amount > 0", null_passes=True)
    assert Q.violations(df, [relaxed]).first()[0] == 1
    table = Q.Constraints()
    with pytest.raises(Q.ConstraintViolation):
        table.add(positive, existing=df)
    table.add(positive)
    with pytest.raises(Q.ConstraintViolation):
        table.check(df)
    assert rows(table.to_df(spark)) == [("positive", "amount > 0")]
    table.drop("positive")
    assert table.check(df).count() == 4
    good, bad = Q.split_valid(df, [positive, Q.Constraint.not_null("id")])
    assert rows(good) == [(1, 5.0)] and bad.count() == 3


def test_expectations(df):
    rules = [Q.Rule("has_id", "id is not null", "drop"), Q.Rule("positive", "amount > 0")]
    kept, metrics = Q.expect(df, rules)
    assert kept.count() == 3
    assert rows(metrics) == [("has_id", "drop", 3, 1), ("positive", "warn", 2, 2)]
    with pytest.raises(Q.ConstraintViolation):
        Q.expect(df, [Q.Rule("positive", "amount > 0", "fail")])


def test_route_names_every_broken_rule_once_per_row(df):
    good, bad = route(df.selectExpr("id", "amount", "if(id = 2, null, 'u') as user"), {"negative": "amount < 0", "no_user": "user is null"})
    assert good.count() == 3
    assert [r.reasons for r in bad.collect()] == [["negative", "no_user"]]
