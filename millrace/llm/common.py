"""Helpers that the operators share."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space of every text contract: space and the control characters 9 to 13.
SPACE = "[\\x20\\x09-\\x0D]"


def text_of(c: str = "text") -> Column:
    """A text column in which NULL is the empty text."""
    return F.coalesce(F.col(c), F.lit(""))


def words_of(c: Column) -> Column:
    """The words of a text, natively: maximal runs of other characters than white space."""
    return F.array_remove(F.split(c, SPACE + "+"), "")


def pieces(batches, names: list[str], text: str, limit: int = 8 << 20) -> Iterator[dict[str, pa.Array]]:
    """Cut Arrow batches into pieces of about ``limit`` bytes of text, at least one row each."""
    for batch in batches:
        columns = {n: batch.column(batch.schema.get_field_index(n)) for n in names}
        sizes = np.cumsum(lengths(columns[text]))
        start = 0
        while start < len(sizes):
            before = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, before + limit, side="right")))
            yield {n: c.slice(start, stop - start) for n, c in columns.items()}
            start = stop


@contextmanager
def no_cycles():
    """For code that makes millions of small tuples and no cycles: looking for some costs a sixth of its time."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def lengths(texts: pa.Array) -> np.ndarray:
    """Bytes of each text; NULL has none."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def joined_bytes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in one array, and where each text starts, with the end of the last."""
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=at[1:])
    return np.frombuffer(b"".join(texts), np.uint8), at


def total_bytes(df: DataFrame, text: str = "text") -> int:
    """Bytes of all texts, to size a layout; one row reaches the driver."""
    return df.agg(F.sum(F.octet_length(text))).first()[0] or 0


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, so that every bit depends on all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def mix2(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit name for the ordered pair (a, b)."""
    return mix(mix(a) * np.uint64(0x9E3779B97F4A7C15) + b)
