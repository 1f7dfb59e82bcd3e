"""Vectors of whole numbers: quantising, packing and exact inner products."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 256.0
LONG = np.iinfo(np.int64)
PART = 1 << 19                 # numbers multiplied at once


def takes_part(vector: str) -> Column:
    """Is the vector there, not empty, and without null or non-finite components?"""
    bad = F.exists(F.col(vector), lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))


def floored(vector: str) -> Column:
    """floor(256 x) of every component; beyond 64 bits the nearest long."""
    return F.transform(F.col(vector), lambda c: F.floor(F.lit(SCALE) * c.cast("double")))


def matrix(values: list, wide: int | None = None) -> np.ndarray:
    """Lists of numbers as rows, padded by zeros."""
    wide = max(map(len, values)) if wide is None else wide
    if all(len(v) == wide for v in values):
        return np.array(values, dtype=np.int64).reshape(len(values), wide)
    out = np.zeros((len(values), wide), dtype=np.int64)
    for r, v in enumerate(values):
        out[r, :len(v)] = v
    return out


def largest(m: np.ndarray) -> int:
    """The largest absolute value; the least long has one too."""
    return max(int(m.max(initial=0)), -int(m.min(initial=0)))


def packed(m: np.ndarray) -> tuple[bytes, bool]:
    """The numbers row by row, in two bytes each if all are small; are they?"""
    small = largest(m) < 1 << 15
    return m.astype("<i2" if small else "<i8").tobytes(), small


def unpacked(held: bytes, n: int, wide: int, small: bool) -> np.ndarray:
    return np.frombuffer(held, dtype="<i2" if small else "<i8").reshape(n, wide).astype(np.int64)


def exact(q: np.ndarray, m: np.ndarray, a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Integer inner products of the pairs q[a], m[r]; beyond 64 bits the nearest long."""
    if largest(q) < 1 << 24 and largest(m) < 1 << 24:
        out = np.zeros(len(a), dtype=np.int64)
        step = max(1, PART // max(1, q.shape[1]))
        for at in range(0, len(a), step):
            s = slice(at, at + step)
            out[s] = np.einsum("ij,ij->i", q[a[s]], m[r[s]])
        return out
    return np.array([min(max(sum(int(x) * int(y) for x, y in zip(q[i], m[j])), LONG.min), LONG.max)
                     for i, j in zip(a.tolist(), r.tolist())], dtype=np.int64)
