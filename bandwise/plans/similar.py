"""Similar pairs from vectors, end to end."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.functions.simhash import vector_length, with_simhash
from bandwise.operators.pairs import document_pairs, with_cosine, with_own_vectors


def similar_pairs(vectors: DataFrame, m: int = 64, bs: Iterable[int] = (8,), k: int | None = 8, seed: int = 42, dim: int | None = None) -> DataFrame:
    """Pairs sharing a band and differing in at most ``k`` of ``m`` bits: ``b, d1, d2, h, cos``.

    ``k=None`` scores every candidate. Vectors go with their signatures into the blocks where pairs meet.
    ``dim`` is the length every vector must have, by default that of any one of them.
    """
    signed = with_own_vectors(with_simhash(vectors, m, seed, dim or vector_length(vectors)), vectors)
    scored = with_cosine(document_pairs(signed, m, list(bs), k), vectors)
    return scored.select(F.explode("bs").alias("b"), "d1", "d2", "h", "cos")
