"""Operator 10: passages repeated across documents, found by recompression of the word sequence."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import joined_bytes, mix, mix2, total_bytes
from .grid import bucket_of, buckets_for, deal, distinct, earlier, ordered, read_bits, shared
from .rolling import windows, words

#: Words in a window that counts as a repeat.
WINDOW = 50
#: Rounds of pair naming. A symbol spans at most 2^ROUNDS words.
ROUNDS = 4
#: Words at each end of a window whose symbols may depend on what stands outside of it: one for a run that the
#: end cuts, then in each round one symbol of the last, so 1 + 1 + 2 + 4 + 8.
EDGE = 2**ROUNDS
#: Bytes of text that are turned into words at once.
CHUNK = 2 << 20


def symbols(names: np.ndarray, text: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Recompress word names: the final symbols and the word at which each starts.

    First every run of one word becomes one symbol, named by the word alone,
    however long; it pairs no more, so what it hides does not spread. Then in
    each round symbols are dealt into left and right by a bit of their name,
    and each left one that a right one of the same text follows is joined with
    it under a name that depends on both only. All names are digests of what
    they stand for, so all tasks agree on them without a dictionary.
    """
    n = len(names)
    new = np.ones(n, bool)
    new[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, n))
    symbol, doc, fixed = names[start], text[start], size > 1
    symbol = np.where(fixed, mix(symbol + np.uint64(1)), symbol)
    for i in range(rounds):
        left = (mix(symbol + np.uint64(2 * i + 11)) & np.uint64(1)).astype(bool)
        joins = left[:-1] & ~left[1:] & ~fixed[:-1] & ~fixed[1:] & (doc[:-1] == doc[1:])
        at = np.flatnonzero(joins)
        symbol[at] = mix2(symbol[at], symbol[at + 1])
        keep = np.ones(len(symbol), bool)
        keep[at + 1] = False
        symbol, doc, fixed, start = symbol[keep], doc[keep], fixed[keep], start[keep]
    return symbol, start


def _chunks(t: pa.Table) -> Iterator[tuple]:
    """A bucket's rows in chunks of about CHUNK bytes: the first row and the number of rows, their bytes, and
    of each word where it starts and stops, its row in the chunk and its name."""
    texts = [x.encode() for x in t.column("_text").to_pylist()]
    row = 0
    while row < len(texts):
        stop, n = row, 0
        while stop < len(texts) and (n == 0 or n + len(texts[stop]) <= CHUNK):
            n += len(texts[stop])
            stop += 1
        raw, at = joined_bytes(texts[row:stop])
        yield row, stop - row, raw, *words(raw, at)
        row = stop


def _symbols_of(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    names, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for row, _, _, _, _, doc, word in _chunks(t):
        symbol, start = symbols(word, doc)
        names.append(symbol)
        rows.append(doc[start] + row)
    return np.concatenate(names), np.concatenate(rows)


def _candidates(t: pa.Table, answers: pa.Table, parts: int) -> Iterator[tuple]:
    """Per chunk: what ``_chunks`` gives and the words at which windows start that could be repeated.

    In equal windows all symbols that touch the words from EDGE to WINDOW - EDGE
    are equal, so a window that a second document holds has only shared ones there.
    """
    names, rows = _symbols_of(t)
    unique, _, _, place = distinct(names, rows)
    is_shared = read_bits(answers, unique, parts)[place]
    used = 0
    for chunk in _chunks(t):
        doc, word = chunk[5], chunk[6]
        _, start = symbols(word, doc)
        flag = np.repeat(is_shared[used : used + len(start)], np.diff(np.append(start, len(word))))
        used += len(start)
        inner = WINDOW - 2 * EDGE
        first = np.arange(max(0, len(word) - WINDOW + 1))
        whole = doc[first] == doc[first + WINDOW - 1]
        count = np.append(0, np.cumsum(flag))
        yield *chunk, first[whole & (count[first + EDGE + inner] - count[first + EDGE] == inner)]


def repeated_windows(t: pa.Table, answers: pa.Table, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, checks and rows of a bucket's candidate windows."""
    out = [(np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64))]
    for row, _, _, _, _, doc, word, first in _candidates(t, answers, parts):
        out.append((*windows(word, first, WINDOW), doc[first] + row))
    return tuple(np.concatenate(x) for x in zip(*out))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """Remove each word covered by a 50-word window that also starts in a document with a smaller id.

    Per row: the id, ``n_words``, ``n_removed``, ``kept_sha256`` and, on demand, ``kept_text``: the kept
    words joined by one space. The texts are shuffled once; a first exchange finds the high-level symbols
    that two documents share, a second one compares the windows made of them by 96-bit names. Windows are
    judged on the input. Rows that share an id never remove words from each other. A NULL id comes after
    all others. NULL, empty and short texts lose nothing. An empty table gives an empty one; other columns
    are not read. A passage that a third of all documents share costs each bucket one name per window.
    """
    n = buckets_for(total_bytes(df, text_col))
    dealt = deal(df, n, id_col, text_col)
    flags = shared(dealt, n, _symbols_of)
    found = earlier(dealt, flags, n, lambda t, o: repeated_windows(t, o, n))
    both = flags.withColumn("_kind", F.lit(0)).unionByName(found.withColumn("_kind", F.lit(1)))
    schema = pa.schema([(id_col, pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
    if with_text:
        schema = schema.append(pa.field("kept_text", pa.string()))

    def apply(t: pa.Table, o: pa.Table) -> pa.Table:
        if t.num_rows == 0:
            return schema.empty_table()
        t = ordered(t)
        flags, found = o.filter(pc.equal(o["_kind"], 0)), o.filter(pc.equal(o["_kind"], 1))
        names, _, rows = repeated_windows(t, flags, n)
        ids = t.column("_id").to_numpy()
        unique, owner, _, place = distinct(names, rows)
        hit = read_bits(found, unique, n)[place] | (ids[rows] > ids[owner][place])
        out, used = [], 0
        for _, size, raw, start, stop, doc, _, first in _candidates(t, flags, n):
            mine = first[hit[used : used + len(first)]]
            used += len(first)
            depth = np.zeros(len(doc) + 1, np.int32)
            depth[mine] += 1
            depth[mine + WINDOW] -= 1
            kept = np.cumsum(depth[:-1]) == 0
            data = raw.tobytes()
            edges = np.searchsorted(doc, np.arange(size + 1)).tolist()
            for a, b in zip(edges, edges[1:]):
                k = np.flatnonzero(kept[a:b]) + a
                text = b" ".join([data[x:y] for x, y in zip(start[k].tolist(), stop[k].tolist())])
                out.append((b - a, b - a - len(k), hashlib.sha256(text).hexdigest(), text.decode())[: 4 if with_text else 3])
        id_out = pc.if_else(t.column("_no_id"), None, t.column("_id"))
        return pa.table([id_out.cast(pa.int64()), *map(list, zip(*out))], schema=schema)

    spark_schema = f"`{id_col}` long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return dealt.groupBy("_b").cogroup(both.groupBy("_b")).applyInArrow(apply, spark_schema)
