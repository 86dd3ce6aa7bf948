"""Small helpers between Arrow arrays and numpy, used inside tasks."""

from __future__ import annotations

from typing import Callable

import numpy as np
import pyarrow as pa


def matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors of equal length as a double matrix; null vectors and null components are refused."""
    if vectors.null_count:
        raise ValueError("null vectors have no place in a matrix")
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if len(vectors) == 0:
        return np.zeros((0, 0))
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)


def vectors(rows: np.ndarray) -> pa.Array:
    """A matrix as an array of lists."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1)))


def over_distinct(fn: Callable, values: pa.Array, kind: pa.DataType) -> pa.Array:
    """Apply a function once per distinct value of a batch; null stays null."""
    encoded = values.dictionary_encode()
    return pa.array([fn(v) for v in encoded.dictionary.to_pylist()], kind).take(encoded.indices)
