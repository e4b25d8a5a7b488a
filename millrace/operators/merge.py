"""MERGE as one DataFrame plan.

``resolve`` pairs every target row with its source row and decides what happens
to it; ``merge`` keeps the resulting rows, ``feed`` the change rows.  Clauses
are tried in order and the first that applies wins; a row that no clause takes
stays as it is.  Conditions and values are SQL text over the aliases ``t`` and
``s``.  NULL keys never match.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import top_n


class MergeCardinalityError(ValueError):
    """A target row is matched by more than one source row."""


@dataclass(frozen=True)
class Clause:
    kind: str
    when: str | None = None
    values: dict[str, str] | None = None


def update(set: dict[str, str] | None = None, when: str | None = None) -> Clause:
    """Matched rows take all source columns, or only the listed expressions."""
    return Clause("update", when, set)


def delete(when: str | None = None) -> Clause:
    return Clause("delete", when)


def insert(values: dict[str, str] | None = None, when: str | None = None) -> Clause:
    """Unmatched source rows are added, with all columns or the listed expressions."""
    return Clause("insert", when, values)


UPSERT = (update(), insert())


def _equal_keys(on: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in on])


def check_cardinality(target: DataFrame, source: DataFrame, on: list[str]) -> None:
    """Raise when a key occurs more than once in ``source`` and exists in ``target``."""
    repeated = source.dropna(subset=on).groupBy(*on).count().where("count > 1").select(*on)
    if not repeated.isEmpty() and not repeated.join(target, on, "left_semi").isEmpty():
        raise MergeCardinalityError(f"several source rows match one target row on {on}")


def evolve_schema(target: DataFrame, source: DataFrame) -> DataFrame:
    """``target`` with the columns only ``source`` has, NULL in every row."""
    new = [f for f in source.schema if f.name not in target.columns]
    return target.withColumns({f.name: F.lit(None).cast(f.dataType) for f in new})


def _action(clauses: list[Clause], present: Column) -> Column:
    chain = F.lit(None).cast("int")
    for i, c in reversed(list(enumerate(clauses))):
        applies = present & F.coalesce(F.expr(c.when), F.lit(False)) if c.when else present
        chain = F.when(applies, F.lit(i)).otherwise(chain)
    return chain


def resolve(
    target: DataFrame,
    source: DataFrame,
    on: list[str],
    clauses: list[Clause] | tuple[Clause, ...] = UPSERT,
    evolve: bool = False,
    dedupe: list[str] | None = None,
    keyed: bool = False,
    check: bool = True,
) -> DataFrame:
    """One row per target row and inserted row: ``action``, ``old`` and ``new`` images.

    ``dedupe`` is an order; only the first source row per key is used.
    ``keyed=True`` states that target keys are unique and allows one full outer
    join.  Otherwise target rows go through a left join, whose skewed side
    adaptive execution can split, and inserts through an anti join against the
    distinct target keys."""
    if dedupe:
        source = top_n(source, on, dedupe, 1)
    elif check and any(c.kind != "insert" for c in clauses):
        check_cardinality(target, source, on)
    if evolve:
        target = evolve_schema(target, source)
    fields = target.schema.fields
    taken = [c for c in clauses if c.kind != "insert"]
    added = [c for c in clauses if c.kind == "insert"]

    def image(pick) -> Column:
        return F.struct(*[pick(f).cast(f.dataType).alias(f.name) for f in fields])

    def updated(c: Clause) -> Column:
        def pick(f):
            if c.values is not None:
                return F.expr(c.values[f.name]) if f.name in c.values else F.col(f"t.{f.name}")
            return F.col(f"s.{f.name}" if f.name in source.columns else f"t.{f.name}")

        return image(pick)

    def inserted(c: Clause) -> Column:
        def pick(f):
            if c.values is not None:
                return F.expr(c.values[f.name]) if f.name in c.values else F.lit(None)
            return F.col(f"s.{f.name}") if f.name in source.columns else F.lit(None)

        return image(pick)

    old = image(lambda f: F.col(f"t.{f.name}"))
    in_t, in_s = F.col("t._in_t").isNotNull(), F.col("s._in_s").isNotNull()
    t = target.withColumn("_in_t", F.lit(True))
    s = source.withColumn("_in_s", F.lit(True))

    def matched_rows(joined: DataFrame) -> DataFrame:
        new, kind = old, F.lit("keep")
        step = _action(taken, in_s)
        for i, c in enumerate(taken):
            kind = F.when(F.col("_step") == i, c.kind).otherwise(kind)
            if c.kind == "update":
                new = F.when(F.col("_step") == i, updated(c)).otherwise(new)
        return joined.withColumn("_step", step).select(kind.alias("action"), old.alias("old"), new.alias("new"))

    def inserted_rows(unmatched: DataFrame) -> DataFrame:
        rows = unmatched.withColumn("_step", _action(added, F.lit(True))).where("_step is not null")
        new = F.lit(None)
        for i, c in enumerate(added):
            new = F.when(F.col("_step") == i, inserted(c)).otherwise(new)
        return rows.select(F.lit("insert").alias("action"), new.alias("new"))

    if keyed and taken and added:
        # NULL keys match nothing; spread them instead of hashing them to one task
        def spread(df: DataFrame) -> DataFrame:
            plain = [f.name for f in df.schema if f.dataType.typeName() not in ("map", "variant")]
            missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
            salt = F.when(missing, F.pmod(F.xxhash64(*plain), F.lit(1024))).otherwise(0)
            return df.withColumn("_salt", salt)

        both = spread(t).alias("t").join(spread(s).alias("s"), _equal_keys(on + ["_salt"]), "full_outer")
        steps = both.withColumn(
            "_step",
            F.when(in_t, _action(taken, in_t & in_s)).otherwise(_action(added, F.lit(True)) + len(taken)),
        ).where(in_t | F.col("_step").isNotNull())
        kind, new = F.lit("keep"), old
        for i, c in enumerate(taken + added):
            kind = F.when(F.col("_step") == i, c.kind).otherwise(kind)
            if c.kind != "delete":
                new = F.when(F.col("_step") == i, (updated if c.kind == "update" else inserted)(c)).otherwise(new)
        return steps.select(kind.alias("action"), F.when(in_t, old).alias("old"), new.alias("new"))

    if taken:
        rows = matched_rows(t.alias("t").join(s.alias("s"), _equal_keys(on), "left"))
    else:
        rows = t.alias("t").select(F.lit("keep").alias("action"), old.alias("old"), old.alias("new"))
    if added:
        keys = target.select(*on).distinct()
        fresh = s.alias("s").join(keys.alias("t"), _equal_keys(on), "left_anti")
        rows = rows.unionByName(inserted_rows(fresh), allowMissingColumns=True)
    return rows


def merge(target: DataFrame, source: DataFrame, on: list[str], clauses=UPSERT, **options) -> DataFrame:
    """The target after the merge; options as in ``resolve``."""
    rows = resolve(target, source, on, clauses, **options)
    return rows.where("action <> 'delete'").select("new.*")


def feed_rows(resolved: DataFrame, version: int, timestamp: Column) -> DataFrame:
    """Change rows of a resolved merge: pre- and post-image of updates, inserts, deletes."""
    changed = resolved.where("action <> 'keep'")

    def entry(kind: str, image: str) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), F.col(image).alias("row"))

    entries = (
        F.when(
            F.col("action") == "update",
            F.array(entry("update_preimage", "old"), entry("update_postimage", "new")),
        )
        .when(F.col("action") == "delete", F.array(entry("delete", "old")))
        .otherwise(F.array(entry("insert", "new")))
    )
    return changed.select(F.explode(entries).alias("e")).select(
        "e.row.*",
        "e._change_type",
        F.lit(version).cast("bigint").alias("_commit_version"),
        timestamp.alias("_commit_timestamp"),
    )


def update_where(df: DataFrame, predicate: str, set: dict[str, str]) -> DataFrame:
    """UPDATE … SET … WHERE; every value is computed from the row before the update."""
    hit = F.coalesce(F.expr(predicate), F.lit(False))
    types = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[
            F.when(hit, F.expr(set[c]).cast(types[c])).otherwise(F.col(c)).alias(c) if c in set else F.col(c)
            for c in df.columns
        ]
    )


def delete_where(df: DataFrame, predicate: str) -> DataFrame:
    """DELETE … WHERE; rows for which the predicate is NULL stay."""
    return df.where(~F.expr(predicate).eqNullSafe(F.lit(True)))


def replace_where(target: DataFrame, df: DataFrame, predicate: str) -> DataFrame:
    """Replace the rows of ``target`` that satisfy ``predicate`` by ``df``.

    Raises when a new row does not satisfy the predicate itself."""
    if not delete_where(df, predicate).isEmpty():
        raise ValueError(f"rows to write violate {predicate!r}")
    return delete_where(target, predicate).unionByName(df)
