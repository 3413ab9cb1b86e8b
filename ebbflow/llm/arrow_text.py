"""Small helpers for Arrow batches of texts inside Spark tasks."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that separate words: space and \\t \\n \\v \\f \\r.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

#: Text bytes handled at once inside a task; bounds the numpy working set.
SLICE_BYTES = 8 << 20


def text_array(column) -> pa.Array:
    """One Arrow string array without nulls (null becomes the empty text)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def sliced(batches, column: str = "text", most: int = SLICE_BYTES):
    """Re-cut an iterator of record batches so that each piece has at most ``most``
    bytes of text, or a single row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        at = batch.schema.get_field_index(column)
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(at)), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a large_string array, and the offsets of its rows in them."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` (one per byte) between consecutive offsets."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Runs of non-space bytes of every text, flat, and the offsets of the texts in them."""
    lists = pc.ascii_split_whitespace(texts)
    values = lists.values
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    full = np.asarray(pc.binary_length(values), dtype=np.int64) > 0
    before = np.zeros(len(full) + 1, np.int64)
    np.cumsum(full, out=before[1:])
    return values.filter(pa.array(full)), before[offsets]


def crc32_of_id(doc_ids: pa.Array) -> np.ndarray:
    """Unsigned CRC-32 of each id written as decimal text (null: of the empty text)."""
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) for i in doc_ids.to_pylist()], np.int64)


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: spreads the bits of unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
