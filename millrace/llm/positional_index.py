"""Operator 12: a positional inverted index of the corpus, and phrases and near terms found by intersecting its lists.

A posting is one word at one place of one document. Documents are cut into
postings where they are read, so the index needs no shuffle; each of its files
holds some documents, sorted by term. A phrase starts from the list of its
rarest term. Lists meet after each place is lowered by the term's place in the
item: what then has the same document and the same alignment belongs together,
however many windows of the item it serves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import pin
from .common import text_of

#: Words of a window.
WINDOW = 10
#: What separates words: all ASCII characters but digits and letters, once letters are small.
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Columns that name a document: two hashes over id and text, 128 bits.
KEY = ("_k1", "_k2")


def words_of(text: Column) -> Column:
    """The words of a text: A-Z made small, other letters as they are."""
    plain = F.octet_length(text) == F.length(text)
    small = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(small, SEPARATORS), "")


def keys(id_col: str, text_col: str) -> list[Column]:
    """The key of a document. Rows with one id and text share it, as they share all matches."""
    return [F.xxhash64(id_col, text_col).alias(KEY[0]), F.xxhash64(F.lit(12), text_col, id_col).alias(KEY[1])]


def items_of(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Test items with words: ``item`` a number of the row, ``item_id`` as text, ``words``. Written once, so numbers stay."""
    rows = items.select(
        F.monotonically_increasing_id().alias("item"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item_id"),
        words_of(text_of(text_col)).alias("words"),
    )
    return pin(rows.where(F.size("words") > 0), "items")


def terms_of(items: DataFrame) -> DataFrame:
    return items.select(F.explode("words").alias("term")).distinct()


def build_index(docs: DataFrame, terms: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the postings of all documents and read them back: the key of the document, ``term``, ``pos``.

    With ``terms`` only words among them are posted; no other can be part of
    a match. Each task posts the documents it reads.
    """
    posts = docs.select(*keys(id_col, text_col), F.posexplode(words_of(text_of(text_col))).alias("pos", "term"))
    if terms is not None:
        posts = posts.join(terms, "term", "left_semi")
    # by hash: what matters is that a list is in one piece, and numbers sort faster than words
    return pin(posts.select(*KEY, "term", "pos").sortWithinPartitions(F.xxhash64("term")), "postings")


def term_counts(index: DataFrame) -> DataFrame:
    return index.groupBy("term").agg(F.count(F.lit(1)).alias("postings"))


def pivots(items: DataFrame, counts: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per window of each item its two rarest terms with their places in the item; windows share most of them.

    A window with a word that the corpus lacks cannot occur and has none. In
    a window of one word both are the same. Written, so that Spark knows the
    size of it: a small table meets the index without moving its lists.
    """
    size = F.size("words")
    placed = items.select("item", size.alias("n"), F.posexplode("words").alias("i", "term")).join(counts, "term")
    length = F.least(F.lit(window), F.col("n"))
    starts = F.sequence(F.greatest(F.lit(0), F.col("i") - length + 1), F.least(F.col("i"), F.col("n") - length))
    listed = (
        placed.select("item", length.alias("length"), F.explode(starts).alias("start"), F.struct("postings", "i", "term").alias("p"))
        .groupBy("item", "start")
        .agg(F.first("length").alias("length"), F.array_sort(F.collect_list("p")).alias("p"))
        .where(F.size("p") == F.col("length"))
    )
    first, second = F.col("p")[0], F.col("p")[F.least(F.lit(1), F.col("length") - 1)]
    pairs = listed.select("item", first["term"].alias("term"), first["i"].alias("i1"), second["term"].alias("term2"), second["i"].alias("i2"))
    return pin(pairs.distinct(), "pivots")


def alignments(index: DataFrame, items: DataFrame, counts: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct ``(key, item, shift)`` at which the two rarest terms of some window both stand: word i of the item at shift + i."""
    rare = pivots(items, counts, window)
    first = index.join(rare, "term").select(
        *KEY, "item", (F.col("pos") - F.col("i1")).alias("shift"), F.col("term2").alias("term"), (F.col("pos") - F.col("i1") + F.col("i2")).alias("pos")
    )
    # the second list is cut to the terms asked for before the lists meet
    second = index.join(rare.select(F.col("term2").alias("term")).distinct(), "term", "left_semi")
    return pin(first.join(second, [*KEY, "term", "pos"]).select(*KEY, "item", "shift").distinct(), "alignments")


def phrase_matches(index: DataFrame, items: DataFrame, counts: DataFrame | None = None, window: int = WINDOW) -> DataFrame:
    """Maximal exact matches: the key, ``item``, ``item_id``, ``start`` in the document and ``length``.

    Every stretch of an item of at least ``window`` words, or a whole item
    with fewer, wherever it stands in a document. All terms of the item are
    intersected at each alignment that its rarest terms left.
    """
    counts = term_counts(index) if counts is None else counts
    at = alignments(index, items, counts, window)
    # the few places asked for, written for their size as well
    asked = at.join(items, "item").select(*KEY, "item", "item_id", "shift", F.size("words").alias("n"), F.posexplode("words").alias("i", "term"))
    asked = pin(asked.withColumn("pos", F.col("shift") + F.col("i")).where("pos >= 0"), "asked")
    # few documents have an alignment: the index is cut to theirs before the lists meet
    some = pin(at.select(*KEY).distinct(), "aligned")
    found = index.join(some, list(KEY), "left_semi").join(asked, [*KEY, "term", "pos"]).select(*KEY, "item", "item_id", "n", "shift", "i").distinct()
    line = W.partitionBy(*KEY, "item", "shift").orderBy("i")  # no more rows than the item has words
    return (
        found.withColumn("run", F.col("i") - F.row_number().over(line))
        .groupBy(*KEY, "item", "item_id", "n", "shift", "run")
        .agg(F.min("i").alias("i"), F.count(F.lit(1)).cast("int").alias("length"))
        .where(F.col("length") >= F.least(F.lit(window), F.col("n")))
        .select(*KEY, "item", "item_id", (F.col("shift") + F.col("i")).alias("start"), "length")
    )


def proximity_matches(index: DataFrame, items: DataFrame, within: int = 20, terms: int = 3) -> DataFrame:
    """Places where the rarest terms of an item stand close together, in any order.

    Of each item its ``terms`` rarest different words, all if it has fewer:
    the key, ``item``, ``item_id`` and ``start``, the places of the rarest word
    with each other one at most ``within`` words away. Places are compared by
    strips of that width, so only neighbours meet.
    """
    ranked = (
        items.select("item", "item_id", F.explode(F.array_distinct("words")).alias("term"))
        .join(term_counts(index), "term", "left")
        .select("item", "item_id", F.struct(F.coalesce("postings", F.lit(0)).alias("postings"), "term").alias("p"))
        .groupBy("item", "item_id")
        .agg(F.slice(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["term"]), 1, terms).alias("rare"))
    )
    strip = F.floor(F.col("pos") / within)
    anchors = index.join(ranked.withColumn("term", F.col("rare")[0]), "term").select(
        *KEY, "item", "item_id", F.col("pos").alias("start"), F.size("rare").alias("n"), F.slice("rare", 2, terms).alias("others")
    )
    alone = anchors.where("n = 1").select(*KEY, "item", "item_id", "start").distinct()
    asked = (
        anchors.where("n > 1")
        .withColumn("term", F.explode("others"))
        .withColumn("strip", F.explode(F.sequence(F.floor(F.col("start") / within) - 1, F.floor(F.col("start") / within) + 1)))
    )
    near = asked.join(index.withColumn("strip", strip), [*KEY, "term", "strip"]).where(F.abs(F.col("pos") - F.col("start")) <= within)
    many = (
        near.select(*KEY, "item", "item_id", "start", "n", "term")
        .distinct()
        .groupBy(*KEY, "item", "item_id", "start", "n")
        .count()
        .where("count = n - 1")
        .select(*KEY, "item", "item_id", "start")
    )
    return many.unionByName(alone)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document how much of it occurs in test items.

    ``n_words``, ``n_hit`` words inside an occurrence of a window, ``n_items``
    different item ids with such windows, ``items_sha256`` over these ids
    sorted as text, ``contaminated``. NULL and empty texts have no words. Rows
    that repeat and rows without id get each their own result; a NULL item id
    counts as the empty one; items without words match nothing. Without items
    no document is hit; an empty table gives no rows; other columns are not
    read.
    """
    listed = items_of(items)
    index = build_index(docs, terms_of(listed), id_col, text_col)
    found = pin(phrase_matches(index, listed, window=window), "matches")
    hit = (
        found.select(*KEY, F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("pos"))
        .distinct()
        .groupBy(*KEY)
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    ids = found.groupBy(*KEY).agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    judged = hit.join(ids, list(KEY))
    rows = docs.select(id_col, *keys(id_col, text_col), F.size(words_of(text_of(text_col))).cast("long").alias("n_words"))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return rows.join(judged, list(KEY), "left").select(
        id_col,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


ORACLE = r"""
with d as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as ws from documents),
b as (select coalesce(item_id::varchar, '') as item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as ws from benchmark),
s as (select item_id, ws, least(10, len(ws)) as n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) as i from b where len(ws) > 0),
w as (select distinct item_id, n, array_to_string(ws[i:i + n - 1], ' ') as x from s),
k as (select distinct n from w),
p as (select doc_id, ws, n, unnest(range(1, greatest(len(ws) - n + 2, 1))) as i from d, k),
g as (select doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') as x from p),
m as (select g.doc_id, item_id, g.n, g.i from g join w on g.n = w.n and g.x = w.x),
h as (select doc_id, count(distinct pos) as n_hit from (select doc_id, unnest(range(i, i + n)) as pos from m) group by doc_id),
t as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
      from (select distinct doc_id, item_id from m) group by doc_id)
select d.doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join h using (doc_id) left join t using (doc_id)
"""
