"""Report queries over quality tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def largest_n(quality: DataFrame) -> DataFrame:
    """Rows of the largest dataset size."""
    top = quality.agg(F.max("n").alias("n"))
    return quality.join(top, "n", "left_semi")


def representative_k(quality: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Rows of the middle threshold of ``ks``, ordered by size."""
    return quality.where(F.col("k") == ks[len(ks) // 2]).orderBy("b", "n")


def scaling_exponent(measured: DataFrame, value: str = "time_sec", by: str = "b") -> DataFrame:
    """Slope of log(value) on log(n): the exponent a of value ~ n ** a, per ``by``."""
    positive = measured.where((F.col(value) > 0) & (F.col("n") > 0))
    return positive.groupBy(by).agg(F.regr_slope(F.log(F.col(value)), F.log(F.col("n"))).alias("exponent"))


def growth_curves(measured: DataFrame, value: str = "time_sec") -> DataFrame:
    """Linear and quadratic growth from the smallest size and value: ``n, linear, quadratic``."""
    start = measured.agg(F.min("n").alias("n0"), F.min(value).cast("double").alias("v0"))
    ratio = F.col("n") / F.col("n0")
    # One row against the handful of sizes.
    return (
        measured.select("n").distinct().join(F.broadcast(start), F.col("n") >= F.col("n0"))
        .select("n", (F.col("v0") * ratio).alias("linear"), (F.col("v0") * ratio * ratio).alias("quadratic"))
    )
