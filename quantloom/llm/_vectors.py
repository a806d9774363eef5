"""Integer vectors: what the vector operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Integer components lie within +-2^27, so that squared distances of 64 components fit a long.
LIMIT = 1 << 27


def usable(vector: str, dims: int) -> Column:
    """A vector of ``dims`` components, none of them null, NaN or infinite."""
    finite = lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce((F.size(vector) == dims) & F.forall(vector, finite), F.lit(False))


def integers(vector: str, scale: int) -> Column:
    """``floor(scale * x)`` of each component x; one beyond ``LIMIT`` is an error, not a wrong distance."""

    def whole(x: Column) -> Column:
        y = F.floor(x.cast("double") * scale)
        return F.when(F.abs(x.cast("double") * scale) < LIMIT, y.cast("int")).otherwise(F.raise_error(F.lit("a vector component is too large for exact distances")).cast("int"))

    return F.transform(vector, whole)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """An Arrow list column of ``dims`` integers a row as an int64 matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def lists(rows: np.ndarray) -> pa.Array:
    """The way back, as lists of int32."""
    n, dims = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * dims), pa.array(rows.ravel().astype(np.int32)))


def decimals(values) -> str:
    return ",".join(str(int(x)) for x in np.ravel(values))


def first_vectors(vectors: DataFrame, order: list[Column], n: int, dims: int) -> np.ndarray:
    """The vectors ``v`` of the first ``n`` rows: a top-n of Spark, ``n`` rows on the driver."""
    rows = vectors.orderBy(*order).limit(n).select("v").collect()
    return np.array([r.v for r in rows], np.int64).reshape(-1, dims)
