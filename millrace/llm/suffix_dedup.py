"""Operator 5: long byte strings repeated across documents, by an interval tree over sorted suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import joined_bytes, mix, total_bytes
from .grid import bucket_of, buckets_for, cuts, deal, distinct, ordered, read_bits, shared
from .rolling import BYTE

#: Bytes in a string that counts as a repeat.
LENGTH = 50
#: Bytes of an anchor. A string's anchor is the one with the least name inside it, the first of equals.
ANCHOR = 16
CHOICES = LENGTH - ANCHOR + 1
#: A context holds the strings of one anchor: at most so many bytes.
CONTEXT = LENGTH + CHOICES - 1
#: Bytes of text handled at once; a longer text is cut into segments that overlap by LENGTH - 1.
CHUNK = 1 << 20
#: Contexts held with their bytes at once, and suffixes sorted at once. Those of one name, and of one name and one
#: distance to its anchor, stay together.
RECORDS = 1 << 16
SUFFIXES = 1 << 16
_PLACE = np.uint64((1 << 24) - 1)


def anchors(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The contexts of all texts in ``raw``, which start ``at``: the anchor's name, the first string's start, how
    many strings follow it start by start, the anchor's place, and the text.

    Every string of LENGTH bytes has one anchor, chosen by its own bytes, so equal strings have equal
    anchors at equal places in them.
    """
    none = np.zeros(0, np.int64)
    if len(raw) < LENGTH:
        return np.zeros(0, np.uint64), none, none, none, none
    h, base = BYTE[raw], 0x9E3779B97F4A7C15
    for size in (1, 2, 4, 8):
        h = h[:-size] * np.uint64(pow(base, size, 1 << 64)) + h[size:]
    key = mix(h) & ~_PLACE | np.arange(len(h), dtype=np.uint64)
    for size in (1, 2, 4, 8, 16):
        key = np.minimum(key[:-size], key[size:])
    key = np.minimum(key[: -(CHOICES - 32)], key[CHOICES - 32 :])
    start = np.arange(len(key))
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))[: len(key)]
    whole = start + LENGTH <= at[text + 1]
    first = whole.copy()
    first[1:] &= (key[1:] != key[:-1]) | ~whole[:-1]
    last = whole.copy()
    last[:-1] &= (key[1:] != key[:-1]) | ~whole[1:]
    a, b = np.flatnonzero(first), np.flatnonzero(last)
    # chosen names are small ones; spread them again, for parts of like sizes
    return mix(key[a] >> np.uint64(24)), a, b - a + 1, (key[a] & _PLACE).astype(np.int64), text[a]


def _segments(t: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """A bucket's texts in pieces of about CHUNK bytes: bytes, where each piece of a text starts, its row and its
    place in the text."""
    texts = [x.encode() for x in t.column("_text").to_pylist()]
    parts, rows, places, size = [], [], [], 0
    for row, text in enumerate(texts):
        for place in range(0, max(1, len(text) - LENGTH + 1), CHUNK):
            part = text[place : place + CHUNK + LENGTH - 1]
            if parts and size + len(part) > CHUNK:
                yield *joined_bytes(parts), np.array(rows), np.array(places)
                parts, rows, places, size = [], [], [], 0
            parts.append(part)
            rows.append(row)
            places.append(place)
            size += len(part)
    if parts:
        yield *joined_bytes(parts), np.array(rows), np.array(places)


def _names(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    names, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for raw, at, row, _ in _segments(t):
        name, _, _, _, text = anchors(raw, at)
        names.append(name)
        rows.append(row[text])
    return np.concatenate(names), np.concatenate(rows)


#: One shared context: its anchor's name, the row in its bucket, the id of the document, its first byte in the
#: text, its length, the anchor's place in it, and its bytes, each plus one, so that 0 is the end.
RECORD = np.dtype(
    [("name", "<u8"), ("anchor", "<u2"), ("bytes", f"S{CONTEXT}"), ("length", "<u2"), ("row", "<u4"), ("start", "<u4"), ("id", "<i8")]
)


def _pack(records: np.ndarray) -> bytes:
    """Records by column, compressed: contexts are text and most numbers are small."""
    raw = b"".join(np.ascontiguousarray(records[f]).tobytes() for f in RECORD.names)
    return pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(block: bytes | pa.Buffer, n: int, low: int = 0, high: int = (1 << 64) - 1) -> np.ndarray:
    """Of ``n`` packed records, sorted by name, those with a name from ``low`` to ``high``."""
    raw, at = pa.decompress(block, n * RECORD.itemsize, codec="zstd", asbytes=True), 0
    names = np.frombuffer(raw, RECORD["name"], n)
    a, b = np.searchsorted(names, np.uint64(low)), np.searchsorted(names, np.uint64(high), side="right")
    records = np.empty(b - a, RECORD)
    for f in RECORD.names:
        kind = RECORD[f]
        records[f] = np.frombuffer(raw, kind, n, at)[a:b]
        at += n * kind.itemsize
    return records


#: Where a context stands, without its bytes.
PLACE = np.dtype([(f, RECORD[f]) for f in ("name", "anchor", "length", "row", "start")])


def _places(t: pa.Table, answers: pa.Table, parts: int) -> np.ndarray:
    """Where a bucket's contexts are whose anchors occur in two documents, sorted by name."""
    out = [np.zeros(0, PLACE)]
    for raw, at, row, begin in _segments(t):
        name, start, count, anchor, text = anchors(raw, at)
        p = np.empty(len(name), PLACE)
        p["name"], p["anchor"], p["length"], p["row"] = name, anchor - start, count + LENGTH - 1, row[text]
        p["start"] = begin[text] + start - at[text]
        out.append(p)
    found = np.concatenate(out)
    del out
    unique, _, _, place = distinct(np.ascontiguousarray(found["name"]), found["row"])
    found = found[read_bits(answers, unique, parts)[place]]
    return found[np.argsort(found["name"], kind="stable")]


def _runs(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Neighbours together, up to ``most`` in all, one at least: first, and behind the last."""
    ends, out, a = np.cumsum(sizes), [], 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right")))
        out.append((a, b))
        a = b
    return out


def _context_runs(t: pa.Table, answers: pa.Table, parts: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """The records of a bucket whose anchors occur in two documents, sorted by name, for some parts at a time: the
    first part, the one behind the last, and the records."""
    found = _places(t, answers, parts)
    ids = t.column("_id").to_numpy()
    raw, begin = joined_bytes([x.encode() for x in t.column("_text").to_pylist()])
    raw = np.append(raw + np.uint8(1), np.zeros(CONTEXT, np.uint8))
    windows = np.lib.stride_tricks.sliding_window_view(raw, CONTEXT)
    at = cuts(np.ascontiguousarray(found["name"]), parts)
    for a, b in _runs(np.diff(at), RECORDS):
        p = found[at[a] : at[b]]
        r = np.empty(len(p), RECORD)
        for f in PLACE.names:
            r[f] = p[f]
        grid = windows[begin[p["row"]] + p["start"]]
        grid[np.arange(CONTEXT, dtype=np.uint16) >= p["length"][:, None]] = 0
        r["bytes"], r["id"] = grid.view(f"S{CONTEXT}")[:, 0], ids[p["row"]]
        yield a, b, r


def _contexts(t: pa.Table, answers: pa.Table, parts: int) -> np.ndarray:
    """All records of a bucket at once."""
    return np.concatenate([np.zeros(0, RECORD), *(r for _, _, r in _context_runs(t, answers, parts))])


def combined(records: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each distinct context of a bucket once, as the record of its first row, which has its least id.

    ``records`` are sorted by name, their rows ascend by id. Returns them so, the spans of records that
    an equal context of a smaller id in the bucket covers, and the other records, with the first one they
    are alike to: what is removed of the first is removed of them.
    """
    same = records["name"][1:] == records["name"][:-1]
    several = np.flatnonzero(np.append(False, same) | np.append(same, False)) if len(records) else np.zeros(0, np.int64)
    r = records[several]
    order = np.lexsort((r["start"], r["row"], r["bytes"], r["anchor"], r["name"]))
    several, r = several[order], r[order]
    new = np.ones(len(r), bool)
    new[1:] = (r["name"][1:] != r["name"][:-1]) | (r["anchor"][1:] != r["anchor"][:-1]) | (r["bytes"][1:] != r["bytes"][:-1])
    more = np.flatnonzero(~new)
    first = np.flatnonzero(new)[(np.cumsum(new) - 1)[more]]
    covered = r["id"][more] > r["id"][first]
    spans = np.zeros(int(covered.sum()), SPAN)
    for f in SPAN.names:
        spans[f] = r[f][more[covered]]
    more, first = more[~covered], first[~covered]
    alike = np.zeros(len(more), ALIKE)
    alike["row"], alike["start"], alike["count"] = r["row"][first], r["start"][first], r["length"][first] - LENGTH + 1
    alike["to_row"], alike["to_start"] = r["row"][more], r["start"][more]
    keep = np.ones(len(records), bool)
    keep[several[~new]] = False
    return records[keep], spans, alike


def expanded(spans: np.ndarray, alike: np.ndarray) -> np.ndarray:
    """The spans, and those that records have in common with the first one they are alike to."""
    if len(alike) == 0 or len(spans) == 0:
        return spans
    at = lambda a: a["row"].astype(np.uint64) << np.uint64(32) | a["start"].astype(np.uint64)
    alike = alike[np.argsort(at(alike), kind="stable")]
    firsts, begins, size = np.unique(at(alike), return_index=True, return_counts=True)
    # each string of a text starts in one context, so the context before a span is the only one it can lie in
    place = np.searchsorted(firsts, at(spans), side="right") - 1
    inside = (place >= 0) & (at(spans) - firsts[place] < alike["count"][begins[place]])
    hit, place = np.flatnonzero(inside), place[inside]
    n = size[place]
    member = alike[np.repeat(begins[place], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    hit = spans[np.repeat(hit, n)]
    more = np.zeros(len(hit), SPAN)
    more["row"], more["start"], more["length"] = member["to_row"], member["to_start"] + (hit["start"] - member["start"]), hit["length"]
    return np.append(spans, more)


def intervals(lcp: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """The nodes of the common-prefix interval tree with a depth of ``least`` or more, children first.

    ``lcp[i]`` is the common prefix of suffixes i - 1 and i, ``lcp[0]`` is 0. One scan with a stack: a
    node opens where the prefix grows and closes where it shrinks. Returns depth, first and last suffix.
    """
    nodes, stack = [], []
    depths = np.where(lcp >= least, lcp, 0)
    # outside of runs of deep prefixes there is nothing to scan
    deep = np.flatnonzero((depths > 0) | (np.append(0, depths[:-1]) > 0))
    for i, depth in zip(deep.tolist(), depths[deep].tolist()):
        begin = i - 1
        while stack and stack[-1][0] > depth:
            top, begin = stack.pop()
            nodes.append((top, begin, i - 1))
        if depth and (not stack or stack[-1][0] < depth):
            stack.append((depth, begin))
    while stack:
        top, begin = stack.pop()
        nodes.append((top, begin, len(lcp) - 1))
    return nodes


def _suffixes(name: np.ndarray, anchor: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The suffixes that start the strings of contexts, sorted by name: the context of each and its place there.

    They come some names at a time; a name with many comes by the distance to its anchor, since only suffixes of
    one distance are alike."""
    new = np.flatnonzero(np.append(True, name[1:] != name[:-1])) if len(name) else np.zeros(0, np.int64)
    edges = np.append(new, len(name))
    for a, b in _runs(np.add.reduceat(count, new) if len(new) else new, SUFFIXES):
        n = count[edges[a] : edges[b]]
        owner = np.repeat(np.arange(edges[a], edges[b]), n)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        if len(owner) <= SUFFIXES:
            yield owner, offset
            continue
        before = anchor[owner] - offset
        order = np.argsort(before, kind="stable")
        ends = np.append(np.flatnonzero(np.diff(before[order])) + 1, len(order))
        for c, d in _runs(np.diff(ends, prepend=0), SUFFIXES):
            some = order[(ends[c - 1] if c else 0) : ends[d - 1]]
            yield owner[some], offset[some]


def repeat_groups(d: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]]:
    """Maximal repeats among the distinct contexts ``d`` of each anchor, sorted by name.

    Yields, some anchors at a time, of the sorted suffixes the context each comes from and its place there; and the
    left-diverse nodes (depth, first, last suffix). A node whose suffixes all stand behind one and the
    same byte is a part of the node one byte longer, and is not listed.
    """
    group = np.append(True, d["name"][1:] != d["name"][:-1])[: len(d)]
    several = np.diff(np.append(np.flatnonzero(group), len(d)))
    use = np.flatnonzero(np.repeat(several, several) > 1)
    names, anchor = d["name"][use], d["anchor"][use].astype(np.int64)
    for owner, offset in _suffixes(names, anchor, d["length"][use].astype(np.int64) - LENGTH + 1):
        low, high = owner.min(), owner.max() + 1
        text = np.zeros((high - low, 2 * CONTEXT), np.uint8)
        text[:, :CONTEXT] = np.ascontiguousarray(d["bytes"][use[low:high]]).view(np.uint8).reshape(-1, CONTEXT)
        at = (owner - low) * text.shape[1] + offset
        suffix = np.lib.stride_tricks.sliding_window_view(text.ravel(), CONTEXT)[at]
        name, before = names[owner], anchor[owner] - offset
        order = np.lexsort((suffix.view(f"S{CONTEXT}")[:, 0], before, name))
        owner, offset, suffix, name, before, at = owner[order], offset[order], suffix[order], name[order], before[order], at[order]
        together = (name[1:] == name[:-1]) & (before[1:] == before[:-1])
        differs = (suffix[1:] != suffix[:-1]) | (suffix[1:] == 0)
        lcp = np.zeros(len(owner), np.int64)
        lcp[1:] = np.where(together, np.where(differs.any(1), differs.argmax(1), CONTEXT), 0)
        left = np.where(offset > 0, text.ravel()[at - (offset > 0)], 0)
        # how many neighbours differ in the byte before them; a context's first string counts as different
        change = np.append(0, np.cumsum(np.append(False, (left[1:] != left[:-1])) | (left == 0)))
        nodes = [(depth, a, b) for depth, a, b in intervals(lcp, LENGTH) if left[a] == 0 or change[b + 1] > change[a + 1]]
        yield use[owner], offset, nodes


def repeated_spans(records: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each record, the spans whose bytes occur in a document with a smaller id: record, start in its context, length."""
    order = np.lexsort((records["id"], records["bytes"], records["anchor"], records["name"]))
    records = records[order]
    if len(records) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    new = np.append(True, (records["name"][1:] != records["name"][:-1]) | (records["anchor"][1:] != records["anchor"][:-1]) | (records["bytes"][1:] != records["bytes"][:-1]))
    first = np.flatnonzero(new)
    context = np.cumsum(new) - 1
    least = records["id"][first]
    # an equal context in an earlier document covers the whole of a later one
    is_later = records["id"] > least[context]
    later = np.flatnonzero(is_later)
    # of a context, only the records of its least id still need the spans inside of it
    heads = np.add.reduceat(~is_later, first, dtype=np.int64)
    found, where, length = [later], [np.zeros(len(later), np.int64)], [records["length"][later].astype(np.int64)]
    for owner, offset, nodes in repeat_groups(records[first]):
        best = np.zeros(len(owner), np.int64)
        ids = least[owner]
        for depth, a, b in nodes:
            own = ids[a : b + 1]
            if (lowest := own.min()) < own.max():
                np.maximum(best[a : b + 1], np.where(own > lowest, depth, 0), out=best[a : b + 1])
        hit = np.flatnonzero(best)
        n = heads[owner[hit]]
        found.append(np.repeat(first[owner[hit]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        where.append(np.repeat(offset[hit], n))
        length.append(np.repeat(best[hit], n))
    return order[np.concatenate(found)], np.concatenate(where), np.concatenate(length)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """Remove each byte covered by a 50-byte string that also starts in a document with a smaller id.

    Per row: the id, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256`` and, on
    demand, ``kept``: the remaining bytes.

    1. Every 50-byte string has an anchor inside of it. One exchange tells which anchors two documents share.
    2. The contexts of shared anchors, up to 84 bytes each, meet by anchor: the parts of a suffix array
       that can hold long repeats. Equal contexts become one; the suffixes of the others are sorted, their
       common prefixes scanned into an interval tree, and left-diverse nodes give the repeats with all of
       their occurrences.
       A bucket of documents sends each distinct context once, so however often a text is repeated, a
       part sees its contexts at most once per bucket.
    3. The spans go back to the buckets, which give them to all their equal contexts; the documents are
       cut in one pass.

    Strings are judged on the input and never cross documents. Rows that share an id never remove bytes
    from each other; a NULL id comes after all others. NULL and short texts lose nothing; an empty table
    gives an empty one; other columns are not read. Texts reach 4 GB each.
    """
    n = buckets_for(total_bytes(df, text_col))
    dealt = deal(df, n, id_col, text_col)
    flags = shared(dealt, n, _names)

    def send(t: pa.Table, o: pa.Table) -> pa.Table:
        if t.num_rows == 0:
            return _NOTHING.empty_table()
        t = ordered(t)
        some, sizes, blocks, own = [], [], [], ([], [])
        for a, b, r in _context_runs(t, o, n):
            r, *settled = combined(r)
            at = cuts(r["name"].astype(np.uint64), n)
            for part in range(a, b):
                if at[part + 1] > at[part]:
                    some.append(part)
                    sizes.append(at[part + 1] - at[part])
                    blocks.append(_pack(r[at[part] : at[part + 1]]))
            for x, y in zip(own, settled):
                x.append(y)
        spans, alike = (np.concatenate(x) for x in own)
        if len(spans) or len(alike):
            # what the bucket settles on its own passes by all parts
            some.append(n + bucket_of(t))
            sizes.append(len(spans))
            blocks.append(spans.tobytes() + alike.tobytes())
        numbers = [some, np.full(len(some), bucket_of(t)), sizes]
        return pa.table([*[pa.array(x, pa.int32()) for x in numbers], pa.array(blocks, pa.binary())], schema=_NOTHING)

    def meet(t: pa.Table) -> pa.Table:
        part = t.column("_part")[0].as_py()
        if part >= n:
            return pa.table([t.column("_b"), t.column("_n"), t.column("_block")], names=["_b", "_n", "_spans"])
        sent = [(x.as_buffer(), size) for x, size in zip(t.column("_block"), t.column("_n").to_pylist())]
        numbers, low, high = t.column("_b").to_numpy(), (part << 64) // n, ((part + 1) << 64) // n
        # the blocks stay packed: some of their names are unpacked at a time
        rounds = -(-sum(size for _, size in sent) // RECORDS)
        buckets, out = [], []
        for i in range(rounds):
            edges = [low + (high - low) * k // rounds for k in (i, i + 1)]
            each = [_unpack(x, size, edges[0], edges[1] - 1) for x, size in sent]
            bucket = np.repeat(numbers, [len(e) for e in each])
            r = np.concatenate(each)
            del each
            at, start, length = repeated_spans(r)
            spans = np.zeros(len(at), SPAN)
            spans["row"], spans["start"], spans["length"] = r["row"][at], r["start"][at] + start, length
            buckets.append(bucket[at])
            out.append(spans)
        bucket, spans = np.concatenate(buckets), np.concatenate(out)
        order = np.argsort(bucket, kind="stable")
        to, begins = np.unique(bucket[order], return_index=True)
        ends = np.append(begins[1:], len(bucket))
        blocks = [spans[order[a:b]].tobytes() for a, b in zip(begins.tolist(), ends.tolist())]
        return pa.table([pa.array(to, pa.int32()), pa.array(ends - begins, pa.int32()), pa.array(blocks, pa.binary())], names=["_b", "_n", "_spans"])

    sent = dealt.groupBy("_b").cogroup(flags.groupBy("_b")).applyInArrow(send, "_part int, _b int, _n int, _block binary")
    spans = sent.groupBy("_part").applyInArrow(meet, "_b int, _n int, _spans binary")
    schema = pa.schema([(id_col, pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
    if with_text:
        schema = schema.append(pa.field("kept", pa.binary()))

    def apply(t: pa.Table, o: pa.Table) -> pa.Table:
        if t.num_rows == 0:
            return schema.empty_table()
        t = ordered(t)
        s, alike = [np.zeros(0, SPAN)], [np.zeros(0, ALIKE)]
        for b, size in zip(o.column("_spans").to_pylist(), o.column("_n").to_pylist()):
            s.append(np.frombuffer(b, SPAN, size))
            alike.append(np.frombuffer(b[size * SPAN.itemsize :], ALIKE))
        s = expanded(np.concatenate(s), np.concatenate(alike))
        s = s[np.argsort(s["row"], kind="stable")]
        edges = np.searchsorted(s["row"], np.arange(t.num_rows + 1))
        out = []
        for row, text in enumerate(t.column("_text").to_pylist()):
            data = text.encode()
            own = s[edges[row] : edges[row + 1]]
            depth = np.zeros(len(data) + 1, np.int32)
            np.add.at(depth, own["start"], 1)
            np.add.at(depth, own["start"] + own["length"], -1)
            gone = np.cumsum(depth[:-1]) > 0
            runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes() if runs else data
            out.append((len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept)[: 5 if with_text else 4])
        id_out = pc.if_else(t.column("_no_id"), None, t.column("_id"))
        return pa.table([id_out.cast(pa.int64()), *map(list, zip(*out))], schema=schema)

    spark_schema = f"`{id_col}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return dealt.groupBy("_b").cogroup(spans.groupBy("_b")).applyInArrow(apply, spark_schema)


SPAN = np.dtype([("row", "<u4"), ("start", "<u4"), ("length", "<u2")])
#: The first record of a context in a bucket, how many strings start in it, and a record alike to it.
ALIKE = np.dtype([("row", "<u4"), ("start", "<u4"), ("count", "<u2"), ("to_row", "<u4"), ("to_start", "<u4")])
_NOTHING = pa.schema([("_part", pa.int32()), ("_b", pa.int32()), ("_n", pa.int32()), ("_block", pa.binary())])
