"""Operator 1: token ids in ORC: run-length encoded integers, row indexes and Bloom filters on the ids."""

from __future__ import annotations

import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from .common import no_cycles, pieces, total_bytes

#: ORC writes integers run-length encoded by itself; the rest makes stripes small enough for many readers
#: and lets a reader skip stripes and row groups.
ORC = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(8 << 20),
    "orc.compress": "ZSTD",
}
#: Bytes of text that go to one file.
FILE_BYTES = 24 << 20

# The normaliser and splitter that the short way stands for, and the characters it holds for.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLITTER = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SAFE = re.compile(r"[\t\n\r -&(-~À-ÖØ-öø-ÿ]*").fullmatch
_SPLIT = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+").findall
# The same for such texts in UTF-8, where bytes from 128 are the lead byte C3 and the letters after it.
_SMALL = bytes.maketrans(bytes([*range(0x41, 0x5B), *range(0x80, 0x9F)]), bytes([*range(0x61, 0x7B), *range(0xA0, 0xBF)]))
_KIND = np.array([1 if b >= 128 or chr(b).isalpha() else 2 if chr(b).isdigit() else 3 if 32 < b < 127 else 0 for b in range(256)], np.uint8)


def _splits_as_known(described: dict) -> bool:
    """Whether a tokenizer's own description has the fixed normaliser and splitter above, and no added token outside ``<|``."""
    steps = (described.get("pre_tokenizer") or {}).get("pretokenizers") or []
    byte_level = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
    return (
        (described.get("normalizer") or {}).get("normalizers") == _NORMALIZERS
        and len(steps) == 2
        and steps[0] == {"type": "Split", "pattern": {"Regex": _SPLITTER}, "behavior": "Removed", "invert": True}
        and byte_level.items() <= steps[1].items()
        and described["model"]["type"] == "BPE"
        and all(t["content"].startswith("<|") for t in described["added_tokens"])
    )


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it prints, else the next free one from 256."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, free = [], 256
    for b in range(256):
        letters.append(chr(b if b in shown else free))
        free += b not in shown
    return letters


class _Words(dict):
    """Word to ids; a word that is not there yet is encoded by the model."""

    def __init__(self, model, letters: list[str]):
        super().__init__()
        self.tokenize, self.letters = model.tokenize, letters

    def __missing__(self, w: str) -> list[int]:
        shown = w if w.isascii() else "".join(map(self.letters.__getitem__, w.encode()))
        ids = self[w] = [t.id for t in self.tokenize(shown)]
        return ids


class WordEncoder:
    """Ids by the tokenizers library.

    Where the file has the normaliser and splitter described above, texts of plain letters, digits and
    punctuation are split together, by the kind of each byte, and their words go to the library's model, each
    distinct one once. Of other texts each distinct piece between spaces and line ends, which normaliser and
    splitter never cross, is encoded once; texts of other files take the library's whole path."""

    #: Words that a task remembers.
    MEMORY = 250_000

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = _splits_as_known(json.loads(self.tokenizer.to_str()))
        self.words = _Words(self.tokenizer.model, _byte_letters())

    def plain(self, text: str) -> bool:
        return self.known and "<|" not in text and _SAFE(text) is not None

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        ids, size = self.encode_flat(pa.array(texts, pa.string()))
        ends = np.cumsum(size).tolist()
        return [ids[a:b].tolist() for a, b in zip([0, *ends], ends)]

    def encode_flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each has."""
        import pyarrow.compute as pc

        listed = texts.to_pylist()
        if not self.known:
            each = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in listed]
            return np.fromiter(chain.from_iterable(each), np.int32), np.fromiter(map(len, each), np.int64, len(each))
        plain = np.fromiter(map(self.plain, listed), bool, len(listed))
        if plain.all():
            return self._encode_plain(listed)
        ids, size = self._encode_plain([t for t, p in zip(listed, plain) if p])
        cut = pc.split_pattern(pc.replace_substring(texts.filter(pa.array(~plain)), "\n", " "), " ")
        rest, more = self._joined(cut.flatten(), cut.offsets.to_numpy() - cut.offsets[0].as_py(), self._piece)
        # back to the order of the texts
        both = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.append(size, more))), pa.int32()), pa.array(np.append(ids, rest), pa.int32()))
        order = np.argsort(np.append(np.flatnonzero(plain), np.flatnonzero(~plain)))
        return both.take(pa.array(order)).flatten().to_numpy(), np.append(size, more)[order]

    def _encode_plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        data = "\n".join([*texts, ""]).encode().translate(_SMALL)
        raw = np.frombuffer(data, np.uint8)
        kind = _KIND[raw]
        # a span is a run of one kind; a digit is one by itself
        new = np.append(True, (kind[1:] != kind[:-1]) | (kind[1:] == 2)) if len(raw) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        spans = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(np.append(at, len(raw)).astype(np.int32)), pa.py_buffer(data)])
        ends = np.cumsum([len(t.encode()) + 1 for t in texts], dtype=np.int64)
        # white space has no ids, so it matters not that a run of it may go on in the next text
        return self._joined(spans, np.append(0, np.searchsorted(at, ends)), self._word)

    def _joined(self, parts: pa.Array, at: np.ndarray, encode) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts, each distinct one encoded once, and how many there are from each place to the next."""
        coded = parts.dictionary_encode()
        with no_cycles():
            if len(self.words) > self.MEMORY:
                self.words.clear()
            each = list(map(encode, coded.dictionary.to_pylist()))
        length = np.fromiter(map(len, each), np.int64, len(each))
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(length)), pa.int32()), pa.array(np.fromiter(chain.from_iterable(each), np.int32)))
        ends = np.append(0, np.cumsum(length[coded.indices.to_numpy()]))
        return lists.take(coded.indices).flatten().to_numpy(), np.diff(ends[at])

    def _word(self, w: str) -> list[int]:
        return [] if w.isspace() else self.words[w]

    def _piece(self, p: str) -> list[int]:
        """The ids of a piece without spaces and line ends."""
        if self.plain(p):
            return list(chain.from_iterable(map(self.words.__getitem__, _SPLIT(p.lower()))))
        return self.tokenizer.encode(p, add_special_tokens=False).ids


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def write_tokens(
    df: DataFrame, to: str, tokenizer: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text", files: int | None = None
) -> None:
    """Encode whole texts and write one ORC row per document, in ascending id order across and inside files.

    Columns: ``doc_id``, ``file_no`` (files in id order), ``first`` (ids before the document in its file),
    ``n_tokens`` and ``ids``. Texts are dealt by ranges of the id, so files do not overlap and each task
    encodes and writes one; no task sees more. Equal ids follow each other, ordered by text. NULL text is
    empty and holds the end id only; NULL ids come first. Other columns are not read; an empty table writes
    files without rows. Executors that are lost repeat their own file.
    """
    n = files or max(1, -(-total_bytes(df, text_col) // FILE_BYTES))
    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    # equal ids in one range; many rows of one id still go to one file, as its order asks
    ordered = rows.repartitionByRange(n, "_id").sortWithinPartitions("_id", "_text")
    kind = df.schema[id_col].dataType.simpleString()

    def turn(batches):
        from pyspark import TaskContext

        number, before = TaskContext.get().partitionId(), 0
        e = _encoder(tokenizer)
        for part in pieces(batches, ["_id", "_text"], "_text", 4 << 20):
            ids, size = e.encode_flat(part["_text"])
            if end_id is not None:
                ids, size = np.insert(ids, np.cumsum(size), end_id), size + 1
            ends = np.cumsum(size)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids, pa.int32()))
            columns = {"doc_id": part["_id"], "file_no": np.full(len(size), number, np.int32)}
            columns |= {"first": before + ends - size, "n_tokens": size, "ids": lists}
            yield pa.RecordBatch.from_pydict(columns)
            before += int(size.sum())

    out = ordered.mapInArrow(turn, f"doc_id {kind}, file_no int, first long, n_tokens long, ids array<int>")
    out.write.options(**ORC).orc(to)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The documents of ``write_tokens``; readers split files by stripes and skip those whose indexes or
    Bloom filters rule out a condition on ``doc_id``."""
    return spark.read.orc(path)


def with_starts(tokens: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Add ``start``, the ids of all documents before; only one row per file is ordered globally.

    The files' sizes are summed from ``stored``, of which Spark reads two integer columns, where ``tokens``
    is something computed from it.
    """
    from pyspark.sql import Window

    files = (stored if stored is not None else tokens).groupBy("file_no").agg(F.sum("n_tokens").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = files.select("file_no", before.alias("_before"))
    return tokens.join(offsets, "file_no").withColumn("start", F.col("first") + F.col("_before")).drop("_before")


def checksums(tokens: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``start``, ``n_tokens`` and the unsigned CRC-32 of its ids as little-endian 32-bit integers."""
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def turn(batches):
        for b in batches:
            ids = b.column(3)
            raw = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
            at = (ids.offsets.to_numpy() - ids.offsets[0].as_py()) * 4
            crc = pa.array([zlib.crc32(raw[x:y]) for x, y in zip(at.tolist(), at[1:].tolist())], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(4), crc], ["doc_id", "file_no", "first", "n_tokens", "ids_crc32"])

    read = tokens.select("doc_id", "file_no", "first", "ids", "n_tokens")
    done = read.mapInArrow(turn, f"doc_id {kind}, file_no int, first long, n_tokens long, ids_crc32 long")
    return with_starts(done, tokens).select("doc_id", "start", "n_tokens", "ids_crc32")


def write_and_read(df: DataFrame, tokenizer: str, end_id: int, label: str = "tokens") -> DataFrame:
    to = work_dir(df.sparkSession, label)
    write_tokens(df, to, tokenizer, end_id)
    return read_tokens(df.sparkSession, to)
