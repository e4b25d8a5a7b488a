"""Operator 3: rake the token weights of a corpus to target shares, then sample by them."""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import pin, planned_once
from .common import text_of, words_of

#: A topic is named by the cue that its text holds most often; ties go to the first name.
TOPICS: dict[str, tuple[str, ...]] = {"arts": ("nd", "qu"), "science": ("st", "ue"), "trade": ("re", "ch")}

#: Shares of tokens to reach, per dimension. Categories that a target does not name share what is left
#: in proportion to their own tokens.
TARGETS: dict[str, dict[str, float]] = {
    "source": {"src0": 0.2},
    "lang": {"en": 0.52, "de": 0.18, "fr": 0.16, "es": 0.13},
    "topic": {"arts": 0.22, "science": 0.2, "trade": 0.57},
}
OTHER = "unknown"

#: Up to this many cells, what a round reads is known to be small before it runs.
FEW_CELLS = 10_000


def topic_of(text: Column, topics: Mapping[str, tuple[str, ...]] = TOPICS) -> Column:
    """The topic with the most cues, ``unknown`` without any."""

    def hits(cues):
        each = [(F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit("")))) / len(c.encode()) for c in cues]
        return sum(each[1:], each[0])

    counts = [(name, hits(cues)) for name, cues in sorted(topics.items())]
    most = F.greatest(*[h for _, h in counts]) if len(counts) > 1 else counts[0][1]
    named = F.when(most <= 0, F.lit(OTHER))
    for name, h in counts:
        named = named.when(h == most, F.lit(name))
    return named.otherwise(F.lit(OTHER))


def described(docs: DataFrame, topics=TOPICS) -> dict[str, Column]:
    """The dimensions of a document and its tokens, here its words, as expressions over ``documents``."""
    text = text_of()
    return {
        "source": F.coalesce(F.col("source").cast("string"), F.lit(OTHER)),
        "lang": F.coalesce(F.col("lang").cast("string"), F.lit(OTHER)),
        "topic": topic_of(text, topics),
        "n_tokens": F.size(words_of(text)).cast("long"),
    }


def _targets(cells: DataFrame, dim: str, shares: Mapping[str, float]) -> DataFrame:
    """``share`` of each category that occurs; those present sum to one."""
    spark = cells.sparkSession
    named = spark.createDataFrame([(k, float(v)) for k, v in shares.items()], f"`{dim}` string, _named double")
    own = cells.groupBy(dim).agg(F.sum("tokens").cast("double").alias("_own")).join(named, dim, "left")
    sums = own.agg(
        F.sum(F.coalesce("_named", F.lit(0.0))).alias("_given"),
        F.sum(F.when(F.col("_named").isNull(), F.col("_own"))).alias("_rest"),
    ).first()
    given, rest = sums["_given"] or 0.0, sums["_rest"] or 0.0
    left = max(0.0, 1.0 - given) if rest else 0.0
    total = (given + left) or 1.0
    part = F.coalesce(F.col("_named"), F.col("_own") * (left / rest if rest else 0.0)) / total
    return own.select(dim, part.alias("share"))


def rake(cells: DataFrame, targets: Mapping[str, Mapping[str, float]] = TARGETS, rounds: int = 40, close: float = 1e-4) -> DataFrame:
    """Iterative proportional fitting of the cells' ``tokens`` to all targets.

    ``cells`` has one row per combination of the dimensions that occurs, and
    ``tokens``. Adds ``weight``: the factor by which a cell's tokens count, so
    that every dimension has its target shares of the total. Each step scales
    one dimension by an aggregate and a join; the cells, not the documents, go
    through the rounds, and each step is written to the shared folder. It
    ends when no share is off by more than ``close``, or after ``rounds``:
    targets that the occurring cells cannot reach together end there.
    Cells without tokens have weight 0.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    now = cells.withColumn("weight", F.when(F.col("tokens") > 0, 1.0).otherwise(0.0))
    if not total:
        return now
    for dim, t in targets.items():
        now = now.join(_targets(cells, dim, t).withColumnRenamed("share", f"_share_{dim}"), dim)
    now = pin(now, "raking")
    before = float("inf")
    for _ in range(rounds):
        worst = 0.0
        for dim in targets:
            now, miss = _scale(now, dim, float(total))
            worst = max(worst, miss)
        # no gain any more: the cells that occur cannot reach all targets together
        if worst <= close or worst > 0.999 * before:
            break
        before = worst
    return now.drop(*[f"_share_{dim}" for dim in targets])


def _scale(now: DataFrame, dim: str, total: float) -> tuple[DataFrame, float]:
    """Bring one dimension to its shares; also the largest correction of a cell that counts.

    The result is written: a plan over a plan that reads its input twice would double with each
    dimension. The correction comes out of the same write.
    """
    sums = now.groupBy(dim).agg(F.sum(F.col("tokens") * F.col("weight")).alias("_sum"))
    factor = F.when(F.col("_sum") > 0, F.col(f"_share_{dim}") * total / F.col("_sum")).otherwise(0.0)
    scaled = now.join(sums, dim).withColumn("_f", factor).withColumn("weight", F.col("weight") * F.col("_f"))
    seen = Observation()
    miss = F.max(F.when(F.col("weight") > 0, F.abs(F.col("_f") - 1)).otherwise(0.0))
    done = pin(scaled.observe(seen, miss.alias("miss")).select(*now.columns), "raked")
    return done, seen.get["miss"] or 0.0


def calibrate(raked: DataFrame, keep: float = 0.5, rounds: int = 20) -> DataFrame:
    """Add ``probability``: min(1, scale x weight), the scale such that ``keep`` of all tokens are expected.

    A cell that would need more than all of its documents has probability 1 and the others make up for it.
    """
    scale, total = 0.0, None
    capped = F.lit(False)
    for _ in range(rounds):
        t = F.col("tokens").cast("double")
        s = raked.agg(
            F.sum(t).alias("all"),
            F.sum(F.when(capped, t)).alias("full"),
            F.sum(F.when(~capped, t * F.col("weight"))).alias("open"),
            F.sum(F.when(capped, 1)).alias("n"),
        ).first()
        want = keep * (s["all"] or 0.0) - (s["full"] or 0.0)
        if not s["open"] or (s["n"] or 0) == total:
            break
        total = s["n"] or 0
        scale = max(scale, want / s["open"])
        capped = F.col("weight") * scale >= 1
    return raked.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * scale))


def draw(id_col: Column, text: Column, seed: int = 17) -> Column:
    """A number in [0, 1) that depends on id, text and seed only, so a lost task draws the same again."""
    h = F.xxhash64(id_col, text, F.lit(seed))
    return h.bitwiseAND(F.lit((1 << 53) - 1)).cast("double") / float(1 << 53)


def _rounds_over(cells: DataFrame):
    """Plan each of the some hundred rounds over few cells once, in as many tasks as they have files."""
    few = cells.count() <= FEW_CELLS
    return planned_once(cells.sparkSession, max(1, len(cells.inputFiles()))) if few else nullcontext()


def plan(docs: DataFrame, targets=TARGETS, keep: float = 0.5, topics=TOPICS) -> DataFrame:
    """The calibrated cells of a corpus: one scan with a combined aggregate, then rounds over the cells."""
    at = described(docs, topics)
    keyed = docs.select(*[c.alias(k) for k, c in at.items()])
    cells = pin(keyed.groupBy(*targets).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")), "cells")
    with _rounds_over(cells):
        return pin(calibrate(rake(cells, targets), keep), "calibrated")


def sample(docs: DataFrame, cells: DataFrame, dims=tuple(TARGETS), topics=TOPICS, seed: int = 17) -> DataFrame:
    """Each document with ``_weight``, ``_probability`` and ``_sampled``, its categories and ``_n`` tokens.

    A column of the documents that has such a name is left out; :func:`kept`
    returns documents as they were.

    NULL dimensions are the category ``unknown``; NULL and empty texts have no
    tokens and, in a cell without tokens, probability 0. Rows that repeat with
    one id and text share their draw. An empty table gives an empty one. The
    join with the cells is left to Spark: small tables are sent to all, others
    meet by key and a hot cell is split.
    """
    drawn = _drawn(docs, cells, dims, topics, seed)
    own = [F.col("_doc").getField(c).alias(c) for c in docs.columns if c not in drawn.columns]
    return drawn.select(*own, *[c for c in drawn.columns if c != "_doc"])


def kept(docs: DataFrame, cells: DataFrame, dims=tuple(TARGETS), topics=TOPICS, seed: int = 17) -> DataFrame:
    """The sampled documents, all their columns unchanged whatever they are called."""
    drawn = _drawn(docs, cells, dims, topics, seed).where("_sampled")
    return drawn.select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns])


def _drawn(docs: DataFrame, cells: DataFrame, dims, topics, seed: int) -> DataFrame:
    at = described(docs, topics)
    names = {d: f"_{d}" for d in dims}
    keyed = docs.select(
        F.struct(*docs.columns).alias("_doc"), *[at[d].alias(names[d]) for d in dims], at["n_tokens"].alias("_n"), draw(F.col("doc_id"), text_of(), seed).alias("_draw")
    )
    side = cells.select(*[F.col(d).alias(names[d]) for d in dims], F.col("weight").alias("_weight"), F.col("probability").alias("_probability"))
    return keyed.join(side, list(names.values())).withColumn("_sampled", F.col("_draw") < F.col("_probability"))
