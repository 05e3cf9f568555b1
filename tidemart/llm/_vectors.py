"""Vectors as whole numbers: exact sums and squared distances."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there and none of its components is null, NaN or infinite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine, F.lit(False))


def largest(dim: int) -> int:
    """Components below this give squared distances of ``dim`` terms that fit a long."""
    return math.isqrt((1 << 60) // max(1, dim))


def whole(column: pa.ListArray, scale: int, dim: int) -> np.ndarray:
    """floor(scale * x) of each component, one row per vector.

    Raises where a squared distance might not fit a long.
    """
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.floor(flat * scale)
    if len(out) and np.abs(out).max() >= largest(dim):
        raise ValueError(f"a component is too large: squared distances of {dim} terms exceed a long")
    return out.astype(np.int64).reshape(-1, dim)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row of ``x`` to each row of ``y`` (both int64).

    Where all sums stay below 2**53, doubles hold them exactly and multiply faster.
    """
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(y).max(initial=0)))
    kind = np.float64 if 4 * x.shape[1] * top * top < 1 << 53 else np.int64
    x, y = x.astype(kind), y.astype(kind)
    out = (x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)
    return out.astype(np.int64)
