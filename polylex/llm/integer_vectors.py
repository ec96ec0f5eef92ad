"""Vectors as exact integers, for the operators that cluster and code them."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A component becomes floor(SCALE * x).
SCALE = 1024
#: Integers beyond it in magnitude would take squared distances out of 64 bits.
MOST = 1 << 27


def usable(vec: Column) -> Column:
    """Not null, not empty, and no component that is null, not finite, or beyond MOST once it is an integer."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) * SCALE < MOST)
    return F.coalesce((F.size(vec) > 0) & F.forall(vec, fine), F.lit(False))


def integers(vec: Column) -> Column:
    """floor(SCALE * x) of every component, as array<int>."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * SCALE).cast("int"))


def matrix(col: pa.ListArray, dim: int) -> np.ndarray:
    """The rows of a list column, all of length dim and without nulls, as 64-bit integers."""
    return col.flatten().to_numpy().astype(np.int64).reshape(-1, dim)


def list_column(m: np.ndarray) -> pa.ListArray:
    """The rows of a matrix as a list column."""
    return pa.ListArray.from_arrays(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1], pa.array(np.ascontiguousarray(m).ravel()))


def as_text(numbers: Iterable[int]) -> str:
    """Decimal integers joined by commas."""
    return ",".join(map(str, numbers))


def sums(dim: int, vec: str = "vec") -> list[Column]:
    """A sum for each component: s0, s1, ..."""
    return [F.sum(F.get(vec, F.lit(k)).cast("long")).alias(f"s{k}") for k in range(dim)]
