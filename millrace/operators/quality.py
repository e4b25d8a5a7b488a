"""Constraints, expectations and data-quality reports."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class ConstraintViolation(ValueError):
    """A batch holds rows that violate a constraint; nothing of it may be written."""


@dataclass(frozen=True)
class Constraint:
    name: str
    expression: str
    null_passes: bool = False

    @staticmethod
    def not_null(column: str) -> Constraint:
        return Constraint(f"{column}_not_null", f"{column} IS NOT NULL")

    @staticmethod
    def check(name: str, expression: str, null_passes: bool = False) -> Constraint:
        """A condition that must hold; a NULL result counts as a violation unless relaxed."""
        return Constraint(name, expression, null_passes)

    def passed(self) -> Column:
        return F.coalesce(F.expr(self.expression), F.lit(self.null_passes))


def violations(df: DataFrame, constraints: list[Constraint]) -> DataFrame:
    """One row: the number of violating rows per constraint, counted in one scan."""
    return df.agg(*[F.count(F.when(~c.passed(), 1)).alias(c.name) for c in constraints])


def require(df: DataFrame, constraints: list[Constraint]) -> None:
    """Raise unless every row satisfies every constraint."""
    if constraints:
        failed = {k: v for k, v in violations(df, constraints).first().asDict().items() if v}
        if failed:
            raise ConstraintViolation(f"violating rows: {failed}")


def _all_pass(constraints: list[Constraint]) -> Column:
    out = F.lit(True)
    for c in constraints:
        out = out & c.passed()
    return out


def _first_broken(constraints: list[Constraint]) -> Column:
    bad = F.lit(None).cast("string")
    for c in reversed(constraints):
        bad = F.when(~c.passed(), F.lit(c.name)).otherwise(bad)
    return bad


def asserted(df: DataFrame, constraints: list[Constraint], keep: Column | None = None) -> DataFrame:
    """``df`` with the constraints as part of its plan: computing a row that violates one fails the job.

    The message names the first constraint that the row violates.  ``keep``
    filters the rows that pass; it is one condition with the assertion, so no
    filter can hide a row from it."""
    keep = F.lit(True) if keep is None else keep
    if not constraints:
        return df.where(keep)
    bad = _first_broken(constraints)
    stop = F.raise_error(F.concat(F.lit("violating rows: "), bad)).cast("boolean")
    return df.where(F.when(bad.isNull(), keep).otherwise(stop))


def split_valid(df: DataFrame, constraints: list[Constraint]) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy all constraints, and the others."""
    ok = _all_pass(constraints)
    return df.where(ok), df.where(~ok)


@dataclass
class Constraints:
    """The constraints of one table."""

    items: dict[str, Constraint] = field(default_factory=dict)

    def add(self, constraint: Constraint, existing: DataFrame | None = None) -> None:
        """Adding fails when rows already in the table violate the constraint."""
        if existing is not None:
            require(existing, [constraint])
        self.items[constraint.name] = constraint

    def drop(self, name: str) -> None:
        del self.items[name]

    def check(self, df: DataFrame) -> DataFrame:
        """``df``, once all its rows are known to be valid."""
        require(df, list(self.items.values()))
        return df

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(c.name, c.expression) for c in self.items.values()]
        return spark.createDataFrame(rows, "name string, expression string")


@dataclass(frozen=True)
class Rule:
    """An expectation: ``on_fail`` is warn, drop or fail."""

    name: str
    condition: str
    on_fail: str = "warn"

    def passed(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


def expect(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that survive the rules, and a metrics DataFrame with one row per rule.

    Both stay lazy, except that a violated ``fail`` rule raises at once.  The
    metrics come from one scan; a NULL condition counts as failed."""
    fail = [r for r in rules if r.on_fail == "fail"]
    require(df, [Constraint(r.name, r.condition) for r in fail])
    kept = df
    for r in rules:
        if r.on_fail == "drop":
            kept = kept.where(r.passed())
    counts = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count(F.when(r.passed(), 1)).alias(r.name) for r in rules],
    )
    actions = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.on_fail)])
    metrics = counts.unpivot("_total", [r.name for r in rules], "rule", "passed").select(
        "rule",
        actions[F.col("rule")].alias("on_fail"),
        "passed",
        (F.col("_total") - F.col("passed")).alias("failed"),
    )
    return kept, metrics


def enforce(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Drop and fail rules as part of a plan, batch or streaming; a row is judged before it is dropped."""
    keep = F.lit(True)
    for r in rules:
        if r.on_fail == "drop":
            keep = keep & r.passed()
    return asserted(df, [Constraint(r.name, r.condition) for r in rules if r.on_fail == "fail"], keep)


def keep_expected(stream: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rules for a plan that is not counted; see ``streaming.expectations`` for one that is."""
    return enforce(stream, rules)


def quality_score(checks: list[Column]) -> Column:
    """Number of checks that hold."""
    score = F.lit(0)
    for c in checks:
        score = score + F.when(c, 1).otherwise(0)
    return score


def quality_report(
    checks: list[tuple[str, DataFrame, dict[str, Column]]],
) -> DataFrame:
    """Rows of tier, check, total, failed and pass rate.

    ``checks`` lists (tier, table, {check name: condition for a failed row}).
    Each table is scanned once, whatever the number of its checks."""
    out = None
    for tier, df, failed in checks:
        counts = df.agg(
            F.count(F.lit(1)).alias("total_rows"),
            *[F.count(F.when(c, 1)).alias(n) for n, c in failed.items()],
        )
        rows = counts.unpivot("total_rows", list(failed), "check_name", "failed_rows").select(
            F.lit(tier).alias("tier"), "check_name", "total_rows", "failed_rows"
        )
        out = rows if out is None else out.unionByName(rows)
    passed = (F.col("total_rows") - F.col("failed_rows")).cast("double")
    return out.withColumn("pass_rate", F.try_divide(passed, F.col("total_rows")))
