"""Vectors as ``array<float>``: cosine, norms and the byte form."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TINY = 1e-9


def unit(vector: Sequence[float]) -> np.ndarray:
    """``vector`` at length one; a zero vector stays as it is."""
    values = np.asarray(vector, dtype=np.float64).reshape(-1)
    norm = np.linalg.norm(values)
    return values / norm if norm > TINY else values


def _similarities(lists: pa.Array, query: np.ndarray) -> np.ndarray:
    """Cosine per row; 0 for a missing, zero or wrongly sized vector."""
    out = np.zeros(len(lists))
    norm = np.linalg.norm(query)
    if not len(query) or norm < TINY:
        return out
    sizes = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(False)
    fits = np.flatnonzero(sizes == len(query))
    if not len(fits):
        return out
    kept = lists if len(fits) == len(lists) else lists.take(pa.array(fits))
    matrix = kept.flatten().to_numpy(zero_copy_only=False).reshape(len(fits), len(query))
    matrix = matrix.astype(np.float64)
    norms = np.linalg.norm(matrix, axis=1)
    dots = matrix @ query
    ok = norms >= TINY
    out[fits[ok]] = dots[ok] / (norms[ok] * norm)
    return np.nan_to_num(out, nan=0.0)


def cosine_to(vector: Column, query: Sequence[float]) -> Column:
    """Cosine of a column of vectors with one query, a batch at a time."""
    fixed = np.asarray(query, dtype=np.float64).reshape(-1)

    @F.arrow_udf(T.DoubleType())
    def score(lists: pa.Array) -> pa.Array:
        return pa.array(_similarities(lists, fixed), pa.float64())

    return score(vector)


def cosine(left: Column, right: Column) -> Column:
    """Cosine of two columns of vectors, inside the JVM; 0 where it is undefined."""

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(
            F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
            F.lit(0.0),
            lambda total, x: total + x,
        )

    norms = F.sqrt(dot(left, left)), F.sqrt(dot(right, right))
    return F.when(
        (F.size(left) == F.size(right)) & (F.size(left) > 0) & (norms[0] >= TINY) & (norms[1] >= TINY),
        dot(left, right) / (norms[0] * norms[1]),
    ).otherwise(F.lit(0.0))


@F.arrow_udf(T.ArrayType(T.FloatType()))
def from_bytes(raw: pa.Array) -> pa.Array:
    """Little-endian float32 bytes as a vector; NULL stays NULL."""
    return pa.array(
        [None if r is None else np.frombuffer(r, "<f4").tolist() for r in raw.to_pylist()],
        pa.list_(pa.float32()),
    )


@F.arrow_udf(T.BinaryType())
def to_bytes(vectors: pa.Array) -> pa.Array:
    return pa.array(
        [None if v is None else np.asarray(v, "<f4").tobytes() for v in vectors.to_pylist()],
        pa.binary(),
    )


def checked(vector: Column, dim: int) -> Column:
    """The vector itself; a job fails on one that is missing or of another width."""
    return (
        F.when(vector.isNull(), F.raise_error(F.lit("chunk without embedding")).cast("array<float>"))
        .when(
            F.size(vector) != dim,
            F.raise_error(
                F.concat(F.lit(f"embedding width is not {dim} but "), F.size(vector).cast("string"))
            ).cast("array<float>"),
        )
        .otherwise(vector)
    )
