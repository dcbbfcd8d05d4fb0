"""Numbers that move between tasks in wide rows: one row for each bucket, with the numbers of each column as bytes."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa


def packed(bucket: np.ndarray, columns: list[np.ndarray]) -> list[pa.Array]:
    """For rows in the order of their buckets: the buckets, and for each column the bytes of its numbers."""
    begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    edges = np.append(begin, len(bucket))

    def wide(c: np.ndarray) -> pa.Array:
        places = pa.py_buffer((edges * c.itemsize).astype(np.int32))
        return pa.Array.from_buffers(pa.binary(), len(begin), [None, places, pa.py_buffer(np.ascontiguousarray(c))])

    return [pa.array(bucket[begin].astype(np.int64)), *map(wide, columns)]


def unpacked(rows: Iterable[pa.Scalar], kind: type) -> list[np.ndarray]:
    """The numbers of each wide row."""
    return [np.frombuffer(r.as_buffer(), kind) for r in rows]


def joined(parts: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *parts])


def top(x: np.ndarray, bits: int) -> np.ndarray:
    """The first ``bits`` bits of 64-bit numbers."""
    return x.view(np.uint64) >> np.uint64(64 - bits)
