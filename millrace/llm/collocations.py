"""Operator 13: phrases that stand together more often than their parts do, counted by sorting suffixes.

Each word of a piece of text starts a suffix, cut to the longest phrase looked
for. Suffixes are dealt out by language and two leading words, so that all
that share a beginning of two words meet, each block of text sending equal
suffixes once with their count. A part then sorts pointers to its suffixes by
multikey quicksort: a partition is split by one word into smaller, equal and
greater; the equal ones go on to the next word, and their weight is the count
of the words so far. Partitions below the least count are abandoned whole.

A pair of leading words that makes up more than a thousandth of the corpus is
dealt out by the third word as well. Every block names the pairs that make up
so much of it; of those with so much of the corpus there are at most a
thousand.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import pin
from .common import mix, mix2, pieces, text_of, total_bytes

#: Words of the longest phrase, least count, share of a longer phrase at which a shorter one goes (percent), phrases per language.
WORDS, LEAST, COVERED, TOP = 3, 10, 50, 2000
#: A leading pair with more than one suffix in so many is dealt out further.
HOT = 1000
#: Bytes of text per part of the sorting, and per block whose equal suffixes are sent once.
PART_BYTES, BLOCK_BYTES = 4 << 20, 4 << 20
UNKNOWN = "und"

#: A-Z become small, marks and line ends end a piece, tabs are spaces: one byte for one byte.
_SMALL = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 10 + b" ")
EMPTY = 0


def _translated(texts: pa.Array) -> pa.Array:
    """The texts as bytes, in small letters and with one kind of separator each."""
    texts = texts.cast(pa.binary())
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = data.slice(int(at[0]), int(at[-1] - at[0])).to_pybytes().translate(_SMALL) if data is not None else b""
    return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer((at - at[0]).astype(np.int32).tobytes()), pa.py_buffer(data)])


def _split(texts: pa.Array, mark: str) -> tuple[pa.Array, np.ndarray]:
    """The parts of all texts, and which text each is from."""
    parts = pc.split_pattern(texts, mark)
    return parts.flatten(), np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy()))


def _suffixes(langs: pa.Array, texts: pa.Array):
    """The languages and words of a block, and its distinct suffixes with their counts.

    A suffix is a column: the number of its language and of up to three words,
    0 where its piece ends."""
    names = langs.dictionary_encode()
    pieces_, text_of_piece = _split(_translated(texts), "\n")
    words, piece = _split(pieces_, " ")
    there = pc.not_equal(words, pa.scalar(b"", pa.binary()))
    words, piece = words.filter(there), piece[there.to_numpy(zero_copy_only=False)]
    coded = words.dictionary_encode()
    number = coded.indices.to_numpy() + np.int32(1)
    lang = names.indices.to_numpy()[text_of_piece[piece]]
    keys = np.zeros((WORDS + 1, len(number)), np.int32)
    keys[0], keys[1] = lang, number
    for k in range(1, WORDS):
        keys[k + 1, :-k] = np.where(piece[k:] == piece[:-k], number[k:], EMPTY)
    words = pa.concat_arrays([pa.array([b""], pa.binary()), coded.dictionary])
    return names.dictionary, words, *_combined(keys, np.ones(len(number), np.int64), len(words))


def _combined(keys: np.ndarray, counts: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Equal columns once, with the sum of their counts."""
    if not keys.shape[1]:
        return keys, counts
    if n_words < 1 << 18 and keys[0].max(initial=0) < 1 << 9:
        one = keys[0].astype(np.int64)
        for k in keys[1:]:
            one = (one << 18) | k
        order = np.argsort(one, kind="stable")
        del one
    else:
        order = np.lexsort(keys[::-1])
    keys, counts = keys[:, order], counts[order]
    new = np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0))
    return keys[:, new], np.add.reduceat(counts, np.flatnonzero(new))


def _blocks(batches):
    for piece in pieces(batches, ["_lang", "_text"], "_text", BLOCK_BYTES):
        yield _suffixes(piece["_lang"], piece["_text"])


def _heads(batches):
    """Counts of the single words of each block, and of the pairs that make up a large share of it."""
    for names, words, keys, counts in _blocks(batches):
        for depth in (1, 2):
            some, total = _combined(keys[: depth + 1], counts, len(words))
            if depth == 2:
                hot = (some[2] != EMPTY) & (total * HOT >= counts.sum())
                some, total = some[:, hot], total[hot]
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": names.take(pa.array(some[0])),
                    "w1": words.take(pa.array(some[1])),
                    "w2": words.take(pa.array(some[2])) if depth == 2 else pa.nulls(len(total), pa.binary()),
                    "n": pa.array(total, pa.int64()),
                }
            )


def _names(values) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, values), np.uint64, len(values))


def _route(lang: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray, hot: np.ndarray, parts: int) -> np.ndarray:
    """The part of each suffix: by language and two words, for the hot pairs by three."""
    pair = mix2(mix2(lang, a), b)
    return (np.where(np.isin(pair, hot), mix2(pair, c), mix(pair)) % np.uint64(parts)).astype(np.int64)


def _dealt(parts: int, hot: np.ndarray):
    """One row per block and part: the words its suffixes have, their numbers and counts, as bytes."""

    def deal(batches):
        for names, words, keys, counts in _blocks(batches):
            two = keys[2] != EMPTY  # a suffix of one word is no phrase
            keys, counts = keys[:, two], counts[two]
            by_name, by_word = _names(names.to_pylist()), _names(words.to_pylist())
            part = _route(by_name[keys[0]], *(by_word[k] for k in keys[1:]), hot, parts)
            order = np.argsort(part, kind="stable")
            keys, counts, part = keys[:, order], counts[order], part[order]
            at = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
            numbers, used, ends = [], [], np.append(at[1:], len(part))
            place = np.zeros(len(words), np.int32)
            for lo, hi in zip(at.tolist(), ends.tolist()):
                own = keys[1:, lo:hi]
                if 16 * own.size > len(words):  # marking the words is quicker than sorting them, unless they are few
                    mark = np.zeros(len(words), bool)
                    mark[own] = True
                    some = np.flatnonzero(mark)
                else:
                    some = np.unique(own)
                place[some] = np.arange(len(some))
                used.append(some)
                numbers.append(np.concatenate([keys[:1, lo:hi].astype(np.int32), place[own]]).tobytes())
            offsets = np.concatenate([[0], np.cumsum([len(u) for u in used])]).astype(np.int32)
            listed = words.take(pa.array(np.concatenate(used))) if used else words[:0]
            yield pa.RecordBatch.from_pydict(
                {
                    "_part": pa.array(part[at], pa.int32()),
                    "_langs": pa.array([names.to_pylist()] * len(at), pa.list_(pa.string())),
                    "_words": pa.ListArray.from_arrays(pa.array(offsets), listed),
                    "_keys": pa.array(numbers, pa.binary()),
                    "_counts": pa.array([counts[lo:hi].astype(np.int64).tobytes() for lo, hi in zip(at.tolist(), ends.tolist())], pa.binary()),
                }
            )

    return deal


def quicksort_counts(keys: np.ndarray, weights: np.ndarray, least: int, whole: int = 0):
    """Sort pointers to rows of words by multikey quicksort; equal partitions as ``(depth, pointer, weight)``.

    ``keys`` has one row of word numbers per depth, 0 where a suffix has
    ended; ``depth`` counts the words that are equal and ``pointer`` is one
    suffix of the partition. Partitions that weigh less than ``least`` are
    abandoned, whatever they hold. All partitions of a round are split at
    once, each by the word of its middle pointer, so that a round is a few
    passes over the pointers left. The first ``whole`` depths count towards no
    phrase (the language).
    """
    order = np.arange(keys.shape[1])
    starts = np.zeros(1 if len(order) else 0, np.int64)  # of the partitions, which fill the pointers
    depth = np.zeros(len(starts), np.int64)
    found = []
    while len(order):
        ends = np.append(starts[1:], len(order))
        sizes = ends - starts
        of = np.repeat(np.arange(len(starts)), sizes)
        word = keys[depth[of], order]
        pivot = word[(starts + ends) // 2]
        side = np.where(word < pivot[of], 0, np.where(word == pivot[of], 1, 2))
        # three partitions for each: their sizes, places and weights
        code = 3 * of + side
        n, heavy = np.bincount(code, minlength=3 * len(starts)), np.bincount(code, weights[order], 3 * len(starts))
        place = np.empty(len(order), np.int64)
        begin = np.concatenate([[0], np.cumsum(n)])[:-1]
        for s in (0, 1, 2):
            mine = side == s
            rank = np.cumsum(mine) - 1
            base = np.repeat(rank[starts] + 1 - mine[starts], sizes)
            place[mine] = (begin[3 * of + s] + rank - base)[mine]
        sorted_order = np.empty_like(order)
        sorted_order[place] = order
        next_depth = np.repeat(depth, 3)
        equal = np.arange(len(n)) % 3 == 1
        ended = equal & (np.repeat(pivot, 3) == EMPTY) & (next_depth >= whole)
        next_depth = next_depth + equal
        keep = (n > 0) & (heavy >= least) & ~ended
        count = keep & equal & (next_depth >= whole)
        found += zip(next_depth[count].tolist(), sorted_order[begin[count]].tolist(), heavy[count].astype(np.int64).tolist())
        keep &= next_depth < len(keys)
        kept = np.flatnonzero(keep)
        order = sorted_order[np.repeat(keep, n)]
        starts = np.concatenate([[0], np.cumsum(n[kept])])[:-1].astype(np.int64)
        depth = next_depth[kept]
    return found


def _sorted(least: int, hot: np.ndarray):
    """Phrases of one part with their counts. Those of hot pairs are counted by third word here, the pair in shares."""

    def count(part: pa.Table) -> pa.Table:
        part = part.combine_chunks()
        coded, words_at = _numbered(part.column("_words"), pa.binary(), b"")
        named, names_at = _numbered(part.column("_langs"), pa.string(), "")
        keys, counts = [], []
        for i, (k, n) in enumerate(zip(part.column("_keys").to_pylist(), part.column("_counts").to_pylist())):
            k = np.frombuffer(k, np.int32).reshape(WORDS + 1, -1)
            keys.append(np.concatenate([named[0][names_at[i] + k[:1]], coded[0][words_at[i] + k[1:]]]))
            counts.append(np.frombuffer(n, np.int64))
        names, words = named[1], coded[1]
        k, w = _combined(np.concatenate(keys, 1), np.concatenate(counts), len(words))
        split = np.zeros(k.shape[1], bool)
        if len(hot):
            by_name, by_word = _names(names.to_pylist()), _names(words.to_pylist())
            split = np.isin(mix2(mix2(by_name[k[0]], by_word[k[1]]), by_word[k[2]]), hot)
        found = []
        for mine, limit in ((~split, least), (split, 1)):  # a share of a hot pair may be small
            at = np.flatnonzero(mine)
            found += [(d - 1, int(at[p]), n) for d, p, n in quicksort_counts(k[:, at], w[at], limit, 1) if d > 2]
        depth, p, n = (np.array(x, np.int64) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 3
        take = lambda of: words.take(pa.array(of)).cast(pa.string())
        third = pa.array(k[3, p], mask=depth < 3)
        return pa.table({"lang": names.take(pa.array(k[0, p])), "w1": take(k[1, p]), "w2": take(k[2, p]), "w3": words.take(third).cast(pa.string()), "n": n})

    return count


def _numbered(lists: pa.ChunkedArray, kind: pa.DataType, first):
    """Numbers of all listed values with the different values, ``first`` being 0; and where each list starts."""
    chunks = [c.flatten().cast(kind) for c in lists.chunks]
    sizes = np.concatenate([np.diff(c.offsets.to_numpy()) for c in lists.chunks])
    flat = pa.concat_arrays([pa.array([first], kind), *chunks]).dictionary_encode()
    return (flat.indices.to_numpy()[1:], flat.dictionary), np.cumsum(sizes) - sizes


def count_phrases(docs: DataFrame, least: int = LEAST, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """Counts of all single words, and of all phrases of two and three words that come ``least`` times or more.

    Both per language: ``lang, word, n`` and ``lang, w1, w2, w3, n``, ``w3``
    NULL for two words; both are written. Two passes over the texts: the first
    counts words and finds the hot pairs, the second deals out the suffixes.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("_lang"), text_of(text_col).alias("_text"))
    heads = rows.mapInArrow(_heads, "lang string, w1 binary, w2 binary, n long").groupBy("lang", "w1", "w2").agg(F.sum("n").alias("n"))
    heads = pin(heads, "words")
    single = heads.where("w2 is null").select("lang", F.col("w1").cast("string").alias("word"), "n")
    total = single.agg(F.sum("n")).first()[0] or 0
    pairs = heads.where(F.col("w2").isNotNull() & (F.col("n") * HOT >= total)).collect()  # at most HOT, by their shares
    name = lambda v: _names([v])
    hot = np.array([mix2(mix2(name(r.lang.encode()), name(bytes(r.w1))), name(bytes(r.w2)))[0] for r in pairs], np.uint64)
    parts = max(1, math.ceil(total_bytes(rows, "_text") / PART_BYTES))
    sent = rows.mapInArrow(_dealt(parts, hot), "_part int, _langs array<string>, _words array<binary>, _keys binary, _counts binary")
    counted = sent.repartition(parts, "_part").groupBy("_part").applyInArrow(_sorted(least, hot), "lang string, w1 string, w2 string, w3 string, n long")
    phrases = counted.groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return single, pin(phrases, "phrases")


def score_phrases(single: DataFrame, phrases: DataFrame) -> DataFrame:
    """``lang, w1, w2, w3, a, l, r, score``: each phrase by the cut that scores lowest, of equal ones the first."""
    word = lambda at, to: single.select("lang", F.col("word").alias(at), F.col("n").alias(to))
    pair = phrases.where("w3 is null")
    exact = lambda l, r: F.expr(f"(cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * 1000000bd) div (cast({l} as decimal(15,0)) * cast({r} as decimal(15,0)))")  # noqa: E731, E741
    two = (
        pair.select("lang", "w1", "w2", "w3", F.col("n").alias("a"))
        .join(word("w1", "l"), ["lang", "w1"])
        .join(word("w2", "r"), ["lang", "w2"])
        .select("lang", "w1", "w2", "w3", "a", "l", "r", exact("l", "r").alias("score"))
    )
    front = pair.select("lang", "w1", "w2", F.col("n").alias("l2"))
    back = pair.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("n").alias("r1"))
    three = (
        phrases.where("w3 is not null")
        .withColumnRenamed("n", "a")
        .join(front, ["lang", "w1", "w2"])
        .join(back, ["lang", "w2", "w3"])
        .join(word("w1", "l1"), ["lang", "w1"])
        .join(word("w3", "r2"), ["lang", "w3"])
        .withColumn("s1", exact("l1", "r1"))
        .withColumn("s2", exact("l2", "r2"))
    )
    first = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang", "w1", "w2", "w3", "a", F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"), F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score")
    )
    return two.unionByName(three)


def uncovered(scored: DataFrame, covered: int = COVERED) -> DataFrame:
    """Without the phrases of two words that a phrase of three holds in ``covered`` percent of their places or more."""
    longer = scored.where("w3 is not null")
    inside = longer.select("lang", "w1", "w2", "a").unionByName(longer.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    most = inside.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longest"))
    short = scored.where("w3 is null").join(most, ["lang", "w1", "w2"], "left")
    return longer.unionByName(short.where(F.coalesce(F.col("longest") * 100 < F.col("a") * covered, F.lit(True))).drop("longest"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The best phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    NULL and empty texts have no words, a NULL language counts as ``und``.
    Rows that repeat count each; ties in score go to the larger count, then
    the phrase that is smaller in bytes. A table without words gives no rows;
    other columns are not read.
    """
    single, phrases = count_phrases(docs, least, text_col, lang_col)
    kept = uncovered(score_phrases(single, phrases)).withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
    by = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # each share of a language names its best, so that the last sort holds a bounded number of rows
    share = F.pmod(F.xxhash64("phrase"), F.lit(8))
    best = kept.withColumn("share", share).withColumn("at", F.row_number().over(W.partitionBy("lang", "share").orderBy(*by))).where(F.col("at") <= top)
    ranked = best.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*by)).cast("long")).where(F.col("rank") <= top)
    words = single.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
with d as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
p as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as ws from d),
i as (select lang, ws, unnest(range(1, len(ws) + 1)) as i from p),
u as (select lang, ws[i] as w, count(*) as f from i group by all),
t as (select lang, sum(f)::bigint as n from u group by lang),
b as (select lang, ws[i] as w1, ws[i + 1] as w2, count(*) as a from i where i < len(ws) group by all having count(*) >= 10),
c as (select lang, ws[i] as w1, ws[i + 1] as w2, ws[i + 2] as w3, count(*) as a from i where i + 1 < len(ws) group by all having count(*) >= 10),
s2 as (select b.lang, w1, w2, null as w3, a, x.f as l, y.f as r, (1000000::hugeint * a * a) // (x.f::hugeint * y.f) as score
       from b join u x on x.lang = b.lang and x.w = w1 join u y on y.lang = b.lang and y.w = w2),
s3 as (select c.lang, c.w1, c.w2, c.w3, c.a, x.f as l1, q.a as r1, f.a as l2, y.f as r2,
              (1000000::hugeint * c.a * c.a) // (x.f::hugeint * q.a) as k1, (1000000::hugeint * c.a * c.a) // (f.a::hugeint * y.f) as k2
       from c join u x on x.lang = c.lang and x.w = c.w1 join b q on q.lang = c.lang and q.w1 = c.w2 and q.w2 = c.w3
              join b f on f.lang = c.lang and f.w1 = c.w1 and f.w2 = c.w2 join u y on y.lang = c.lang and y.w = c.w3),
m as (select lang, w1, w2, max(a) as m from (select lang, w1, w2, a from c union all select lang, w2, w3, a from c) group by all),
k as (select s2.lang, s2.w1 || ' ' || s2.w2 as phrase, a, l, r, score from s2 left join m on m.lang = s2.lang and m.w1 = s2.w1 and m.w2 = s2.w2
      where m.m is null or 100 * m.m < 50 * a
      union all
      select lang, w1 || ' ' || w2 || ' ' || w3, a, case when k1 <= k2 then l1 else l2 end, case when k1 <= k2 then r1 else r2 end, least(k1, k2) from s3),
o as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from k)
select o.lang, rank, phrase, a, l, r, t.n, score::bigint as score from o join t on t.lang = o.lang where rank <= 2000
"""
