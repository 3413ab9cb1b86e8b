"""Vector columns as binary rows, and best-first selections, shared by the vector operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Vectors (rows of a matrix) handled at once inside a task.
CHUNK = 1024


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector has no null and no non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return df.where(F.col(vector).isNotNull() & ~bad)


def common_length(df: DataFrame, vector: str = "embedding") -> int:
    """The length that most vectors have (the smaller of equally frequent ones; 0 without rows)."""
    sizes = df.groupBy(F.size(vector).alias("n")).agg(F.count("*").alias("rows"))
    best = sizes.agg(F.max(F.struct("rows", -F.col("n"))).alias("m")).first().m
    return -best[1] if best else 0


def binary(values: np.ndarray) -> pa.Array:
    """Rows of a matrix as a binary column."""
    values = np.ascontiguousarray(values)
    width = values.shape[1] * values.itemsize
    offsets = np.arange(len(values) + 1, dtype=np.int64) * width
    return pa.Array.from_buffers(pa.large_binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(values)]).cast(pa.binary())


def matrix(column: pa.Array, dtype: str, length: int) -> np.ndarray:
    """Rows of a binary column, ``length`` numbers each, as a matrix."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or length == 0:
        return np.zeros((len(column), length), dtype)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]].view(dtype).reshape(len(column), length)


def first_k(group: np.ndarray, score: np.ndarray, tie: np.ndarray, k: int, same: np.ndarray | None = None) -> np.ndarray:
    """Positions of the ``k`` highest scores of every group, smaller ``tie`` first among equal
    ones, in order. Entries of a group with the same tie and ``same`` count once."""
    if not len(group):
        return np.zeros(0, np.int64)
    keys = (tie, -score, group) if same is None else (same, tie, -score, group)
    order = np.lexsort(keys)
    if same is not None:
        g, s, t = group[order], same[order], tie[order]
        again = np.concatenate([[False], (g[1:] == g[:-1]) & (s[1:] == s[:-1]) & (t[1:] == t[:-1])])
        order = order[~again]
    g = group[order]
    starts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    rank = np.arange(len(g)) - np.repeat(starts, np.diff(np.append(starts, len(g))))
    return order[rank < k]
