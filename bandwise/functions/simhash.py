"""Sign-random-projection signatures: one matrix product per Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BITS = 64


def hyperplanes(m: int, dim: int, seed: int = 42) -> np.ndarray:
    """``m`` Gaussian normals of length ``dim``.

    Rows are drawn in order, so the first rows of a larger draw are the smaller
    draw: an ``m``-bit signature is a bit prefix of any longer one.
    """
    return np.random.RandomState(seed).randn(m, dim)


def list_matrix(column: pa.Array) -> np.ndarray:
    """The non-null lists of an Arrow list column as one float64 matrix."""
    lengths = pc.list_value_length(column).drop_null().to_numpy()
    if len(lengths) == 0:
        return np.empty((0, 0))
    if (lengths != lengths[0]).any():
        raise ValueError("vectors must all have the same length")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(len(lengths), int(lengths[0]))


def pack_bits(bits: np.ndarray) -> np.ndarray:
    """Boolean rows to rows of signed 64-bit words; bit j of the row is bit j % 64 of word j // 64."""
    n, m = bits.shape
    words = -(-m // WORD_BITS)
    packed = np.zeros((n, words * 8), dtype=np.uint8)
    packed[:, : -(-m // 8)] = np.packbits(bits, axis=1, bitorder="little")
    return packed.view("<i8")


def simhash(vec: Column | str, m: int = 64, seed: int = 42) -> Column:
    """Signature of a vector column: bit j is set when plane j has a strictly positive product.

    LONG for ``m <= 64``, otherwise ARRAY<LONG> of 64-bit words. The planes are drawn
    again from the seed inside each task, so nothing is broadcast. NULL vectors and those
    with an element that is NULL or not finite get NULL.
    """
    if m < 1:
        raise ValueError("m must be positive")
    wide = m > WORD_BITS

    def sign_bits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        planes = None
        for column in batches:
            if isinstance(column, pa.ChunkedArray):
                column = column.combine_chunks()
            matrix = list_matrix(column)
            words = -(-m // WORD_BITS)
            packed = np.zeros((len(column), words), dtype=np.int64)
            present = column.is_valid().to_numpy(zero_copy_only=False)
            finite = np.isfinite(matrix).all(axis=1)
            matrix = matrix[finite]
            present[present] = finite
            if matrix.shape[0]:
                if planes is None or planes.shape[1] != matrix.shape[1]:
                    planes = hyperplanes(m, matrix.shape[1], seed)
                packed[present] = pack_bits(matrix @ planes.T > 0)
            if wide:
                offsets = pa.array(np.arange(len(column) + 1, dtype=np.int32) * words)
                yield pa.ListArray.from_arrays(offsets, pa.array(packed.ravel()), mask=pa.array(~present))
            else:
                yield pa.array(packed[:, 0], mask=~present)

    sign_bits.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    as_signature = F.arrow_udf(sign_bits, "array<bigint>" if wide else "bigint")
    return as_signature(F.col(vec) if isinstance(vec, str) else vec)


def vector_length(vectors: DataFrame) -> int | None:
    """Length of any one vector, which all others must then have."""
    row = vectors.where(F.col("vec").isNotNull()).select(F.size("vec").alias("dim")).first()
    return row.dim if row else None


def with_simhash(vectors: DataFrame, m: int = 64, seed: int = 42, dim: int | None = None) -> DataFrame:
    """Add ``sig`` to ``(doc_id, vec)`` rows; ``dim`` asserts the vector length."""
    vec = F.col("vec")
    if dim is not None:
        vec = F.when(vec.isNull() | (F.size(vec) == dim), vec).otherwise(F.raise_error(F.lit(f"vector is not of length {dim}")))
    return vectors.withColumn("sig", simhash(vec, m, seed))


def l2_norm(vec: Column | str) -> Column:
    """Euclidean length, summed in double precision."""
    vec = F.col(vec) if isinstance(vec, str) else vec
    return F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def with_norm(vectors: DataFrame) -> DataFrame:
    """Add ``norm`` to ``(doc_id, vec)`` rows."""
    return vectors.withColumn("norm", l2_norm("vec"))
