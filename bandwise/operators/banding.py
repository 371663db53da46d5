"""Band keys and bucket sizes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.functions.bits import WORD_BITS, band_array, band_width

BUCKET = ["b", "band_idx", "band_val"]


def band_keys(signatures: DataFrame, m: int, bs: Iterable[int]) -> DataFrame:
    """One row per signature, band count and band: the input columns plus ``b, band_idx, band_val``.

    Rows without a signature have no bands.
    """
    bs = list(bs)
    kept = [F.col(c) for c in signatures.columns]
    bands = signatures.select(*kept, F.inline(band_array("sig", m, bs)))
    # On the key, not on sig: that test would move below the projection and compute signatures twice.
    wide = any(band_width(m, b) > WORD_BITS for b in bs)
    return bands.where("band_val[0] is not null" if wide else "band_val is not null")


def bucket_sizes(bands: DataFrame) -> DataFrame:
    """Rows per bucket, pre-aggregated before the shuffle."""
    return bands.groupBy(*BUCKET).agg(F.count(F.lit(1)).alias("bucket_size"))
