"""Operator 4: exact duplicates, combined in three stages that one hot text cannot overload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, text_of

#: Salted groups per digest. A digest has at most this many rows in the last stage.
SALTS = 16

_KEY = ["_digest", "_bytes", "_check"]


def without_space(c: str = "text") -> Column:
    """The text with all white space deleted."""
    return F.regexp_replace(text_of(c), SPACE + "+", "")


def exact_dedup(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", normal: Column | None = None, salts: int = SALTS
) -> DataFrame:
    """Group rows whose normalised texts are equal; name the row of each group that stays.

    One row per input row: the id, ``keep_id``, ``group_size``, ``kept`` and
    ``text_sha256``. The row with the most code points in its original text
    stays, then the smallest id.

    1. Each map task combines its own copies (the partial aggregate below the
       first shuffle).
    2. Groups of (digest, whole text, salt of the task) are merged, so a text
       that holds a third of all rows meets in ``salts`` groups, after stage 1
       with one row per task.
    3. The winners of the salts, at most ``salts`` rows a text, are combined.

    The whole normalised text is part of the key in every stage, so texts are
    compared, not only their digests. The answer goes back to the rows by
    digest, length and a second hash; should two texts share all three, the
    job fails rather than merge them.

    NULL text counts as empty; empty texts form one group. A NULL id loses
    every tie and is returned as it came. Rows that repeat an id stay one row
    each, and all with ``keep_id`` are kept only once per distinct id, text and
    length: equal rows are equal decisions. An empty table gives an empty one.
    Other columns of the input are not read, whatever their names.
    """
    rows = df.select(
        F.col(id_col).alias("_id"),
        F.length(text_of(text_col)).cast("long").alias("_chars"),
        (without_space(text_col) if normal is None else normal).alias("_text"),
    )
    keyed = rows.select(
        "_id",
        "_chars",
        F.sha2("_text", 256).alias("_digest"),
        F.octet_length("_text").cast("long").alias("_bytes"),
        F.xxhash64("_text").alias("_check"),
        "_text",
    )
    # more code points win, then the smaller id: one sortable number with a fixed width, so the
    # aggregates stay hash aggregates; a NULL id comes after all others
    rank = F.col("_chars").cast("decimal(38,0)") * F.lit(str(2**65)).cast("decimal(20,0)") - F.coalesce(
        F.col("_id").cast("decimal(20,0)"), F.lit(str(2**64)).cast("decimal(20,0)")
    )
    salted = keyed.select(
        "*", rank.cast("decimal(38,0)").alias("_rank"), (F.spark_partition_id() % salts).alias("_salt")
    )
    local = salted.groupBy(*_KEY, "_text", "_salt").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_rank").alias("_best"), F.max_by("_id", "_rank").alias("_keep")
    )
    whole = local.groupBy(*_KEY, "_text").agg(
        F.sum("_n").alias("group_size"), F.max_by("_keep", "_best").alias("keep_id")
    )
    single = whole.groupBy(*_KEY).agg(
        F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("two texts share a digest")).cast("long"))
        .otherwise(F.max("group_size"))
        .alias("group_size"),
        F.max("keep_id").alias("keep_id"),
    )
    # one column as key: both sides are then shuffled for the join alone, which lets Spark split a hot one
    name = F.concat_ws(":", *_KEY)
    answer = single.select(name.alias("_name"), "keep_id", "group_size")
    return keyed.select("_id", "_digest", name.alias("_name")).join(answer, "_name").select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("_digest").alias("text_sha256"),
    )


ORACLE = r"""
with d as (select doc_id, length(coalesce(text, '')) as c,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') as n from documents),
g as (select doc_id, n, first_value(doc_id) over (partition by n order by c desc, doc_id) as keep_id,
             count(*) over (partition by n) as group_size from d)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(n) as text_sha256 from g
"""
