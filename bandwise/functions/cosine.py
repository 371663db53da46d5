"""Dot products and cosine of two vector columns, one Arrow batch at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from bandwise.functions.simhash import list_matrix


def _pairwise(left: pa.Array, right: pa.Array, combine) -> pa.Array:
    both = pc.and_(left.is_valid(), right.is_valid())
    present = both.to_numpy(zero_copy_only=False)
    out = np.full(len(left), np.nan)
    if present.any():
        out[present] = combine(list_matrix(left.filter(both)), list_matrix(right.filter(both)))
    return pa.array(out, mask=np.isnan(out))


def dot(left: Column, right: Column) -> Column:
    """Dot product in double precision; NULL when a side is NULL."""

    def dot_batch(a: pa.Array, b: pa.Array) -> pa.Array:
        return _pairwise(a, b, lambda x, y: np.einsum("ij,ij->i", x, y))

    dot_batch.__annotations__ = {"a": pa.Array, "b": pa.Array, "return": pa.Array}
    return F.arrow_udf(dot_batch, "double")(left, right)


def cosine(left: Column, right: Column) -> Column:
    """Exact cosine in double precision; NULL when a side is NULL or has length zero."""

    def cosine_batch(a: pa.Array, b: pa.Array) -> pa.Array:
        def ratio(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            lengths = np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))
            with np.errstate(divide="ignore", invalid="ignore"):
                return np.where(lengths > 0, np.einsum("ij,ij->i", x, y) / lengths, np.nan)

        return _pairwise(a, b, ratio)

    cosine_batch.__annotations__ = {"a": pa.Array, "b": pa.Array, "return": pa.Array}
    return F.arrow_udf(cosine_batch, "double")(left, right)


def angle_cosine(h: Column, m: int) -> Column:
    """Cosine implied by a Hamming distance: each bit differs with probability angle / pi."""
    return F.cos(h * F.pi() / F.lit(float(m)))
