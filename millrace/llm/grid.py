"""Names shared between documents, found by an exchange of packed names between buckets of documents.

Documents are dealt into buckets by the hash of their id, names into parts by
their leading bits. For n bytes of text there are about as many buckets as
parts, both in proportion to the root of n, so what one bucket sends to one
part keeps its size at any scale. A bucket sends each of its names once,
sorted, as one block of bytes per part; the part answers with one bit per
name. However often a text is repeated, a part sees it at most once per
bucket.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ids of documents without one: they come after all others.
NO_ID = 2**63 - 1


def buckets_for(n_bytes: int) -> int:
    return max(1, math.ceil(math.sqrt(n_bytes) / 128))


def deal(df: DataFrame, n: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_b``, ``_id`` and ``_text`` of all rows, in ``n`` buckets; the only shuffle of the texts."""
    rows = df.select(
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(n)).cast("int").alias("_b"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"),
        F.col(id_col).isNull().alias("_no_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    )
    return rows.repartition(n, "_b")


def ordered(t: pa.Table) -> pa.Table:
    """A bucket's rows in an order that every stage finds again; equal rows are interchangeable."""
    return t.sort_by([("_id", "ascending"), ("_no_id", "ascending"), ("_text", "ascending")])


def bucket_of(t: pa.Table) -> int:
    return t.column("_b")[0].as_py()


def distinct(names: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct names; of each the first and last owner (owners ascend); and for each input its place."""
    order = np.argsort(names, kind="stable")
    s = names[order]
    new = np.append(True, s[1:] != s[:-1]) if len(s) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(s)) - 1 if len(s) else first
    place = np.empty(len(s), np.int64)
    place[order] = np.cumsum(new) - 1
    return s[first], owner[order[first]], owner[order[last]], place


def cuts(names: np.ndarray, parts: int) -> np.ndarray:
    """Where each part starts in sorted 64-bit names, with the end."""
    edges = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)
    return np.concatenate([[0], np.searchsorted(names, edges), [len(names)]]).astype(np.int64)


def _send(bucket: int, parts: int, at: np.ndarray, columns: list[np.ndarray]) -> pa.Table:
    """One row per part that gets any name: the columns' bytes one after the other."""
    some = np.flatnonzero(at[1:] > at[:-1])
    blocks = [b"".join(c[at[i] : at[i + 1]].tobytes() for c in columns) for i in some.tolist()]
    return pa.table(
        {
            "_part": pa.array(some, pa.int32()),
            "_b": pa.array(np.full(len(some), bucket), pa.int32()),
            "_n": pa.array(np.diff(at)[some], pa.int32()),
            "_block": pa.array(blocks, pa.binary()),
        }
    )


_SENT = "_part int, _b int, _n int, _block binary"
_BITS = "_b int, _part int, _bits binary"


def shared(dealt: DataFrame, parts: int, names_of: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Which names occur in two documents or more.

    ``names_of`` gives the names of a bucket and the row of each, rows in
    ascending order. Returns ``_b``, ``_part`` and one bit per distinct name of
    the bucket in that part.
    """

    def send(t: pa.Table) -> pa.Table:
        t = ordered(t)
        names, row = names_of(t)
        ids = t.column("_id").to_numpy()
        unique, first, last, _ = distinct(names, row)
        several = ids[first] != ids[last] if len(unique) else np.zeros(0, bool)
        return _send(bucket_of(t), parts, cuts(unique, parts), [unique, several.astype(np.uint8)])

    def answer(t: pa.Table) -> pa.Table:
        sizes = t.column("_n").to_numpy()
        blocks = t.column("_block").to_pylist()
        names = np.concatenate([np.frombuffer(b, np.uint64, n) for b, n in zip(blocks, sizes)])
        several = np.concatenate([np.frombuffer(b, np.uint8, n, 8 * n) for b, n in zip(blocks, sizes)])
        order = np.argsort(names, kind="stable")
        s = names[order]
        same = s[1:] == s[:-1]
        found = np.append(False, same) | np.append(same, False) | (several[order] > 0)
        bits = np.empty(len(names), bool)
        bits[order] = found
        return _answers(t, sizes, bits)

    return dealt.groupBy("_b").applyInArrow(send, _SENT).groupBy("_part").applyInArrow(answer, _BITS)


def earlier(
    dealt: DataFrame, other: DataFrame, parts: int, names_of: Callable[[pa.Table, pa.Table], tuple[np.ndarray, np.ndarray, np.ndarray]]
) -> DataFrame:
    """Which names of a bucket occur in a document of another bucket with a smaller id than all of the bucket's own.

    ``names_of`` gets a bucket and its rows of ``other``, and gives 64-bit
    names, 32-bit checks and the row of each. Names are equal when both are.
    """

    def send(t: pa.Table, o: pa.Table) -> pa.Table:
        if t.num_rows == 0:
            return _send(0, parts, np.zeros(parts + 1, np.int64), [])
        t = ordered(t)
        names, check, row = names_of(t, o)
        ids = t.column("_id").to_numpy()
        unique, first, _, place = distinct(names, row)
        checks = np.zeros(len(unique), np.uint32)
        checks[place] = check
        return _send(bucket_of(t), parts, cuts(unique, parts), [unique, checks, ids[first]])

    def answer(t: pa.Table) -> pa.Table:
        sizes = t.column("_n").to_numpy()
        blocks = t.column("_block").to_pylist()
        names = np.concatenate([np.frombuffer(b, np.uint64, n) for b, n in zip(blocks, sizes)])
        checks = np.concatenate([np.frombuffer(b, np.uint32, n, 8 * n) for b, n in zip(blocks, sizes)])
        ids = np.concatenate([np.frombuffer(b, np.int64, n, 12 * n) for b, n in zip(blocks, sizes)])
        order = np.lexsort((ids, checks, names))
        new = np.append(True, (names[order][1:] != names[order][:-1]) | (checks[order][1:] != checks[order][:-1]))
        least = ids[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        bits = np.empty(len(names), bool)
        bits[order] = ids[order] > least
        return _answers(t, sizes, bits)

    sent = dealt.groupBy("_b").cogroup(other.groupBy("_b")).applyInArrow(send, _SENT)
    return sent.groupBy("_part").applyInArrow(answer, _BITS)


def _answers(t: pa.Table, sizes: np.ndarray, bits: np.ndarray) -> pa.Table:
    ends = np.cumsum(sizes)
    packed = [np.packbits(bits[e - n : e]).tobytes() for e, n in zip(ends.tolist(), sizes.tolist())]
    return pa.table({"_b": t.column("_b"), "_part": t.column("_part"), "_bits": pa.array(packed, pa.binary())})


def read_bits(answers: pa.Table, names: np.ndarray, parts: int) -> np.ndarray:
    """The bits of a bucket's sorted distinct names, from all parts."""
    at = cuts(names, parts)
    bits = np.zeros(len(names), bool)
    for part, packed in zip(answers.column("_part").to_pylist(), answers.column("_bits").to_pylist()):
        a, b = at[part], at[part + 1]
        bits[a:b] = np.unpackbits(np.frombuffer(packed, np.uint8), count=b - a)
    return bits
