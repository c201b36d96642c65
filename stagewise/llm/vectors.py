"""Vectors as integers (operators 12 and 13)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole(vector: Column | str) -> Column:
    """True if a vector is there and all its components are finite numbers."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector.cast("array<double>"), finite), F.lit(False))


def floors(vector: Column | str, scale: int) -> Column:
    """array<long> of floor(scale * x), computed on doubles."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * float(scale)).cast("long"))


def extent(df: DataFrame, q: str = "q") -> tuple[int, int, int, float]:
    """Rows, longest vector (1 at least), greatest component and greatest squared length (all
    absolute), as one row fetched from Spark."""
    double = F.transform(q, lambda x: x.cast("double"))
    square = F.aggregate(double, F.lit(0.0), lambda a, x: a + x * x)
    r = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(q)).alias("dims"), F.max(square).alias("square"),
               F.max(F.array_max(F.transform(double, lambda x: F.abs(x)))).alias("most")).first()
    return r["n"], max(1, r["dims"] or 0), int(r["most"] or 0), r["square"] or 0.0


def matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """A column of integer lists as rows of ``dims`` numbers; short ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy()
    out = np.zeros((len(column), dims), np.int64)
    flat = column.flatten().to_numpy()
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(-1, dims).astype(np.int64, copy=False)
    out[np.arange(dims)[None] < sizes[:, None]] = flat
    return out
