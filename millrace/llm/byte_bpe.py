"""Operator 6: byte-level BPE by a rank queue over linked symbols, and back."""

from __future__ import annotations

import base64
import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import no_cycles, pieces


#: Bytes of text that a task encodes at once.
PIECE = 12 << 20


class RankQueue:
    """Buckets of positions per rank under a bitmap of bitmaps: the lowest rank is found by three
    find-first-set steps however many ranks there are."""

    def __init__(self, ranks: int):
        self.levels = []
        while not self.levels or len(self.levels[-1]) > 1:
            ranks = -(-ranks // 64)
            self.levels.append([0] * max(ranks, 1))
        self.buckets: dict[int, list[np.ndarray]] = {}

    def push(self, rank: int, positions: np.ndarray) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(positions)
            return
        self.buckets[rank] = [positions]
        for level in self.levels:
            rank, bit = rank >> 6, 1 << (rank & 63)
            seen = level[rank]
            level[rank] = seen | bit
            if seen:
                return

    def push_all(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Each position to the bucket of its rank; negative ranks are none."""
        some = ranks >= 0
        ranks, positions = ranks[some], positions[some]
        if len(ranks) == 0:
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist(), len(ranks)]
        for rank, a, b in zip(ranks[starts[:-1]].tolist(), starts, starts[1:]):
            self.push(rank, positions[a:b])

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank and the positions filed under it, stale ones included."""
        if not self.levels[-1][0]:
            return None
        rank = 0
        for level in reversed(self.levels):
            word = level[rank]
            rank = (rank << 6) | ((word & -word).bit_length() - 1)
        found = self.buckets.pop(rank)
        at = rank
        for level in self.levels:
            at, bit = at >> 6, 1 << (at & 63)
            level[at] &= ~bit
            if level[at]:
                break
        return rank, found[0] if len(found) == 1 else np.concatenate(found)


class Vocabulary:
    """The merges of a rank file: the id of a token is its rank."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.bytes = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(keys)
        #: Tokens that a merge can turn into one of a lower rank; after others no word needs a check.
        self.opens = np.zeros(len(self.tokens), bool)
        for key, rank in pairs.items():
            for part in (key >> 32, key & 0xFFFFFFFF):
                if rank < part:
                    self.opens[part] = True
        # a last key that no pair has: a search never runs over the end
        self.keys = np.append(keys[order], np.int64(2**62))
        self.values = np.append(np.fromiter(pairs.values(), np.int32, len(pairs))[order], np.int32(-1))

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 for pairs that do not merge."""
        key = a.astype(np.int64) << 32 | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.values[at], -1)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in one array, and where each word starts in it, with the end.

        All words are one linked list of symbols with gaps between words. The
        lowest rank in the queue is the lowest of every word that has it, so
        one step merges it wherever it occurs. If a merge opens a still lower
        rank in its word, only the word's first merge is done in this step, as
        word by word encoding would.
        """
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        text = np.frombuffer(b"".join(words), np.uint8)
        n = len(text)
        if n == 0:
            return np.zeros(0, np.int32), np.zeros(len(words) + 1, np.int64)
        symbol = self.bytes[text]
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        following = np.arange(1, n + 1, dtype=np.int32)
        following[ends[sizes > 0] - 1] = -1
        previous = np.arange(-1, n - 1, dtype=np.int32)
        previous[(ends - sizes)[sizes > 0]] = -1
        inside = following >= 0
        rank_at = np.full(n, -1, np.int32)
        at = np.flatnonzero(inside).astype(np.int32)
        rank_at[at] = self.pair(symbol[at], symbol[following[at]])
        dead = np.zeros(n, bool)
        queue = RankQueue(len(self.tokens))
        queue.push_all(rank_at[at], at)
        while (step := queue.pop()) is not None:
            rank, found = step
            found = found[rank_at[found] == rank]
            if len(found) == 0:
                continue
            found = np.sort(found)
            right = following[found]
            if len(found) > 1 and (joint := found[1:] == right[:-1]).any():
                # a chain of overlapping pairs, as in "aaaa": from its start every other one merges
                index = np.arange(len(found))
                start = np.maximum.accumulate(np.where(np.append(True, ~joint), index, 0))
                p = found[(index - start) % 2 == 0]
            else:
                p = found
            q = following[p]
            after, before = following[q], previous[p]
            beside = np.append(False, before[1:] == q[:-1])
            lower = self._lower(symbol, rank, before, after, beside) if self.opens[rank] else None
            if lower is not None and lower.any():
                late = np.isin(word[p], word[p[lower]])
                first = np.append(True, word[p[1:]] != word[p[:-1]])
                queue.push(rank, found[np.isin(word[found], word[p[lower]])])
                p = p[~late | first]
                q = following[p]
                after, before = following[q], previous[p]
                beside = np.append(False, before[1:] == q[:-1])
            symbol[p] = rank
            following[p] = after
            previous[after[after >= 0]] = p[after >= 0]
            dead[q] = True
            rank_at[q] = -1
            changed = np.concatenate([p, before[(before >= 0) & ~beside]])
            to = following[changed]
            ranks = np.where(to >= 0, self.pair(symbol[changed], symbol[to]), -1).astype(np.int32)
            rank_at[changed] = ranks
            queue.push_all(ranks, changed)
        alive = ~dead
        starts = np.zeros(len(words) + 1, np.int64)
        starts[1:] = np.append(0, np.cumsum(alive))[ends]
        return symbol[alive], starts

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As ``merge``; a word that is a token as a whole is that token."""
        whole = np.array([self.ranks.get(w, -1) for w in words], np.int64)
        open_ = whole < 0
        ids, at = self.merge([w for w, o in zip(words, open_.tolist()) if o])
        size = np.ones(len(words), np.int64)
        size[open_] = np.diff(at)
        starts = np.zeros(len(words) + 1, np.int64)
        np.cumsum(size, out=starts[1:])
        all_ids = np.empty(starts[-1], np.int32)
        merged = np.repeat(open_, size)
        all_ids[merged] = ids
        all_ids[~merged] = whole[~open_]
        return all_ids, starts

    def _lower(self, symbol, rank, before, after, beside) -> np.ndarray:
        """Whether a merge to ``rank`` opens a pair of a lower rank beside it."""
        left = np.where(beside, rank, symbol[before])
        new = np.full(len(before), rank, np.int32)
        a = np.where(before >= 0, self.pair(left, new), -1)
        b = np.where(after >= 0, self.pair(new, symbol[after]), -1)
        return ((a >= 0) & (a < rank)) | ((b >= 0) & (b < rank))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _gather(flat: np.ndarray, starts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``at`` of ``flat`` one after the other, and where each starts, with the end."""
    size = starts[at + 1] - starts[at]
    to = np.zeros(len(at) + 1, np.int64)
    np.cumsum(size, out=to[1:])
    return flat[np.arange(to[-1]) + np.repeat(starts[at] - to[:-1], size)], to


def _codes(items: list[str]) -> tuple[list[str], np.ndarray]:
    """The distinct items in order, and for each item its place among them."""
    seen = dict.fromkeys(items)
    place = dict(zip(seen, range(len(seen))))
    return list(seen), np.fromiter(map(place.__getitem__, items), np.int64, len(items))


class Encoder:
    """Texts to ids: texts fall into pieces, pieces into pre-tokens, and only distinct ones are merged."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary = Vocabulary(path)
        self.split = regex.compile(pattern).findall

    def parts(self, text: str) -> list[str]:
        """Pieces that no match of the pattern crosses: a space after another character than white
        space starts a match, whatever follows."""
        if re.search(r"\s ", text):
            return re.split(r"(?<=\S)(?= )", text)
        return text.replace(" ", "\x00 ").split("\x00") if "\x00" not in text else re.split(r"(?<=\S)(?= )", text)

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and where each text starts in it, with the end."""
        with no_cycles():
            return self._encode_all(texts)

    def _encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cut = [self.parts(t) for t in texts]
        distinct, piece_at = _codes(list(chain.from_iterable(cut)))
        tokens = [(p,) if p[1:].isalpha() and (p[0] == " " or p[0].isalpha()) else self.split(p) for p in distinct]
        words, word_at = _codes(list(chain.from_iterable(tokens)))
        ids, starts = self.vocabulary.encode([w.encode() for w in words])
        ids, spans = _gather(ids, starts, word_at)
        of_piece = spans[np.append(0, np.cumsum([len(t) for t in tokens], dtype=np.int64))]
        ids, spans = _gather(ids, of_piece, piece_at)
        return ids, spans[np.append(0, np.cumsum([len(c) for c in cut], dtype=np.int64))]


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One per Python worker and vocabulary."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(path, pattern)
    return _encoders[path, pattern]


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id and ``ids``, the whole text's tokens.

    One pass without a shuffle; a task holds one piece of about 12 MB of text
    (or one longer text). NULL and empty texts have no tokens. Rows that
    repeat stay; an empty table gives an empty one; other columns are not read.
    """

    def turn(batches):
        e = encoder(path, pattern)
        for part in pieces(batches, ["_id", "_text"], "_text", PIECE):
            ids, at = e.encode_all(part["_text"].to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_pydict({"_id": part["_id"], "ids": lists})

    return _turned(df, turn, id_col, text_col, "ids array<int>")


def _turned(df: DataFrame, turn, id_col: str, text_col: str, columns: str) -> DataFrame:
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return rows.mapInArrow(turn, f"_id {kind}, {columns}").withColumnRenamed("_id", id_col)


def round_trip(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each text, decode its ids, and return digests of both with ``n_tokens``; cases as for ``encode``."""

    def turn(batches):
        e = encoder(path, pattern)
        names = [str(i) for i in range(len(e.vocabulary.tokens))]
        sha = hashlib.sha256
        for part in pieces(batches, ["_id", "_text"], "_text", PIECE):
            ids, at = e.encode_all(part["_text"].to_pylist())
            each = [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_pydict(
                {
                    "_id": part["_id"],
                    "n_tokens": np.diff(at),
                    "ids_sha256": [sha(",".join(map(names.__getitem__, x)).encode()).hexdigest() for x in each],
                    "decoded_sha256": [sha(e.vocabulary.decode(x)).hexdigest() for x in each],
                }
            )

    return _turned(df, turn, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string")
