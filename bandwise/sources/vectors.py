"""Vector tables: ``(doc_id LONG, vec ARRAY<FLOAT>)``, and the first n rows of one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CUTOFF_RANGES = 4096


def read_vectors(spark: SparkSession, path: str, id_col: str = "doc_id", vec_col: str = "vec") -> DataFrame:
    """A parquet table of vectors with its id and vector columns renamed."""
    return spark.read.parquet(path).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(vec_col).cast("array<float>").alias("vec")
    )


def first_n(vectors: DataFrame, n: int, dense: bool = True) -> DataFrame:
    """The n rows with the smallest ids.

    Dense ids (row positions) need only a filter, which reaches the scan. For sparse
    ids the cut-off id is found first by counting, see :func:`prefix_cutoff`.
    """
    if n <= 0:
        return vectors.where(F.lit(False))
    if dense:
        return vectors.where(F.col("doc_id") < n)
    cutoff = prefix_cutoff(vectors, n)
    return vectors if cutoff is None else vectors.where(F.col("doc_id") <= cutoff)


def prefix_cutoff(vectors: DataFrame, n: int) -> int | None:
    """The n-th smallest id, or None when there are at most n rows.

    Each round counts ids in a few thousand equal ranges and keeps the range where
    the running count passes n. Only those counts reach the driver and no sort is
    needed; 64-bit ids take at most six rounds.
    """
    ids = vectors.select("doc_id")
    total, low, high = ids.agg(F.count("doc_id"), F.min("doc_id"), F.max("doc_id")).first()
    if total <= n:
        return None
    below = 0
    while low < high:
        width = -(-(high - low + 1) // CUTOFF_RANGES)
        offset = F.col("doc_id").cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")
        counts = (
            ids.where(F.col("doc_id").between(low, high))
            .groupBy(F.floor(offset / F.lit(width).cast("decimal(20,0)")).cast("long").alias("part"))
            .count()
            .orderBy("part")
            .collect()
        )
        for part, count in counts:
            if below + count >= n:
                low, high = low + part * width, min(high, low + (part + 1) * width - 1)
                break
            below += count
    return low
