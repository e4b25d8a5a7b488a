"""Operator 7: a ledger of quality rules: measured once, judged by any policy."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of, words_of

#: Words in a window whose repetition counts.
WINDOW = 8


def _distinct(c: Column) -> Column:
    return F.size(F.array_distinct(c)).cast("long")


def _paired(names: Column, step: int) -> Column:
    """64-bit names of windows twice as long, from the names of windows of ``step`` words."""
    n = F.greatest(F.size(names) - step, F.lit(0))
    return F.zip_with(F.slice(names, 1, n), F.slice(names, step + 1, n), lambda a, b: F.xxhash64(a, b))


def _all_differ(names: Column) -> Column:
    return F.size(names) == F.size(F.array_distinct(names))


def _with(value: Column, use) -> Column:
    """``use(value)``, the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeated(words: Column) -> Column:
    """How many words lie in a window whose words come twice or more in the text.

    Windows are compared as texts: they are sorted with their places, those
    equal to a neighbour are marked, and each marked place adds the words up to
    the next marked one, at most a whole window.
    """
    places = F.sequence(F.lit(0), F.size(words) - WINDOW)
    windows = F.array_sort(
        F.transform(places, lambda i: F.struct(F.array_join(F.slice(words, i + 1, F.lit(WINDOW)), " ").alias("w"), i.alias("i")))
    )
    marked = _with(windows, _marked)
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        marked,
        start,
        lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(WINDOW), i - s["last"]).cast("long")).alias("n")),
        lambda s: s["n"],
    )


def _marked(windows: Column) -> Column:
    """Places of the sorted windows that equal a neighbour."""
    n = F.size(windows)
    empty = F.array().cast("array<struct<w:string,i:int>>")
    before = F.concat(F.array(F.lit(None).cast("struct<w:string,i:int>")), F.when(n > 1, F.slice(windows, 1, n - 1)).otherwise(empty))
    after = F.when(n > 1, F.slice(windows, 2, n - 1)).otherwise(empty)
    pairs = F.arrays_zip(windows.alias("a"), before.alias("b"), after.alias("c"))
    equal = F.filter(pairs, lambda p: (p["a"]["w"] == p["b"]["w"]) | (p["a"]["w"] == p["c"]["w"]))
    return F.array_sort(F.transform(equal, lambda p: p["a"]["i"]))


def measure(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every measurement of every document, once: the id and one long per measurement."""
    text = text_of(text_col)
    words = df.select(F.col(id_col), text.alias("_text"), words_of(text).alias("_words"))
    hashed = words.select(
        "*",
        F.filter(F.split("_text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("_lines"),
        _paired(_paired(F.col("_words"), 1), 2).alias("_names"),
    )
    names = F.col("_names")
    long = lambda c: c.cast("long")
    return hashed.select(
        F.col(id_col),
        long(F.size("_words")).alias("n_words"),
        long(F.length(F.array_join("_words", ""))).alias("word_chars"),
        long(F.length(F.regexp_replace("_text", "[^#*$%&|<>]+", ""))).alias("n_symbols"),
        (F.size("_lines") - _distinct(F.col("_lines"))).cast("long").alias("n_dup_lines"),
        # equal windows have equal names, and so have their first four words: without any there is nothing to compare
        F.when(_all_differ(names), F.lit(0).cast("long"))
        .when(_with(_paired(names, 4), _all_differ), F.lit(0).cast("long"))
        .otherwise(_repeated(F.col("_words")))
        .alias("n_repeat_words"),
        long(F.size("_lines")).alias("n_lines"),
        long(F.octet_length("_text") - F.octet_length(F.replace("_text", F.lit("!"), F.lit("")))).alias("n_marks"),
        long(F.size(F.array_remove(F.zip_with("_words", F.slice("_words", 2, F.size("_words")), lambda a, b: a.eqNullSafe(b)), False))).alias("n_echoes"),
    )


#: Rules by bit: name and the condition under which a document fails, on the measurements.
RULES: tuple[tuple[str, str], ...] = (
    ("too_few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > word_chars"),
    ("duplicate_lines", "n_lines >= 4 and 10 * n_dup_lines > 3 * n_lines"),
    ("long_words", "n_words >= 20 and word_chars > 20 * n_words"),
    ("exclamation_marks", "n_words >= 20 and 5 * n_marks > n_words"),
    ("echoes", "n_words >= 20 and 10 * n_echoes > 3 * n_words"),
)

#: Policies by version: the rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": ("too_few_words", "repeated_windows"),
    "v2": ("too_few_words", "repeated_windows", "symbols", "duplicate_lines", "exclamation_marks", "echoes"),
}


def mask_of(names: tuple[str, ...], rules=RULES) -> int:
    """The bit mask of some rules; an unknown name is an error."""
    bit = {name: 1 << i for i, (name, _) in enumerate(rules)}
    return sum(bit[n] for n in set(names))


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """The measurements of each document and ``fail_bits``, bit i for a failure of rule i.

    Every rule runs once, whatever policies are applied later. NULL and empty
    texts have no words and fail what their counts fail. A rule whose
    condition is NULL does not fail. Rows that repeat stay as they are; an
    empty table gives an empty ledger; other columns are not read.
    """
    bits = F.lit(0).cast("long")
    for i, (_, fails) in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return measure(df, id_col, text_col).withColumn("fail_bits", bits)


def apply_policy(led: DataFrame, mask: int, name: str = "kept") -> DataFrame:
    """Whether each document passes all rules of the mask."""
    return led.withColumn(name, F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")) == 0)


def ablations(led: DataFrame, policies: Mapping[str, tuple[str, ...]] = POLICIES, rules=RULES) -> DataFrame:
    """Per policy and rule of it: documents the rule rejects, and those that only it rejects.

    One aggregate over the ledger, without the texts. The counts of distinct
    bit patterns are combined before the shuffle; patterns are at most two to
    the number of rules.
    """
    plan = [(v, n, mask_of(names, rules), mask_of((n,), rules)) for v, names in policies.items() for n in names]
    spark = led.sparkSession
    table = spark.createDataFrame(plan, "policy string, rule string, mask long, bit long")
    patterns = led.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    failed = F.col("fail_bits").bitwiseAND(F.col("mask"))
    return (
        patterns.join(F.broadcast(table), F.lit(True))
        .groupBy("policy", "rule")
        .agg(
            F.sum(F.when(failed.bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("rejected"),
            F.sum(F.when(failed == F.col("bit"), F.col("n")).otherwise(0)).alias("rejected_alone"),
        )
    )


ORACLE = r"""
with w as (select doc_id, coalesce(text, '') as t,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
           from documents),
n as (select doc_id, t, ws, ls, unnest(range(1, greatest(len(ws) - 6, 1))) as i from w),
p as (select doc_id, i, array_to_string(ws[i:i + 7], ' ') as x from n),
q as (select doc_id, i, count(*) over (partition by doc_id, x) as c from p),
r as (select doc_id, i, coalesce(lead(i) over (partition by doc_id order by i), 1000000000) as nxt from q where c > 1),
s as (select doc_id, sum(least(8, nxt - i)) as n_repeat_words from r group by doc_id),
m as (select w.doc_id, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols,
             len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
             len(ls) as n_lines, length(regexp_replace(t, '[^!]', '', 'g')) as n_marks, len(list_filter(range(2, len(ws) + 1), lambda j: ws[j] = ws[j - 1])) as n_echoes
      from w left join s using (doc_id)),
f as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 10 * n_symbols > word_chars or (n_lines >= 4 and 10 * n_dup_lines > 3 * n_lines)
            or (n_words >= 20 and 5 * n_marks > n_words)
            or (n_words >= 20 and 10 * n_echoes > 3 * n_words)) as kept,
       ((n_words < 20)::bigint + 2 * (100 * n_repeat_words > 30 * n_words)::bigint + 4 * (10 * n_symbols > word_chars)::bigint
        + 8 * (n_lines >= 4 and 10 * n_dup_lines > 3 * n_lines)::bigint + 16 * (n_words >= 20 and word_chars > 20 * n_words)::bigint
        + 32 * (n_words >= 20 and 5 * n_marks > n_words)::bigint
        + 64 * (n_words >= 20 and 10 * n_echoes > 3 * n_words)::bigint)::bigint as fail_bits
from f
"""
