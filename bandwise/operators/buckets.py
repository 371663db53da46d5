"""Exact splitting of hot buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.durable import broadcast_if_small, durable

MANY_BLOCKS = 64
LARGE_BLOCK = 16
TASK_PAIRS, TASK_BYTES, MOST_TASKS = 100_000_000, 32 * 1024 * 1024, 4000


def hot_keys(rows: DataFrame, keys: list[str], limit: int, label: str) -> tuple[DataFrame, int, int]:
    """Keys with more than ``limit`` rows and the blocks ``g`` each needs, their count, and the largest ``g``.

    Each row is sent once per block, so beyond ``MANY_BLOCKS`` blocks grow, up to
    ``LARGE_BLOCK`` times the limit, before their number does.
    """
    blocks = F.ceil(F.col("_rows") / limit)
    large = F.ceil(F.col("_rows") / (limit * LARGE_BLOCK))
    hot = durable(
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > limit)
        .select(*keys, F.greatest(F.least(blocks, F.lit(MANY_BLOCKS)), large).cast("int").alias("g")),
        label,
    )
    found, largest = hot.agg(F.count(F.lit(1)), F.max("g")).first()
    return broadcast_if_small(hot, found), found, largest or 1


def block_pairs(rows: DataFrame, keys: list[str], spread: list[str]) -> DataFrame:
    """The rows of each two blocks of a key: ``rows`` by ``keys, i, j`` with ``side``, 0 for block i and 1 for block j.

    A key without ``g`` is one block, to be paired with itself. A key with ``g`` is cut by
    the hash of the ``spread`` columns into g blocks, and its pairs spread over
    g * (g + 1) / 2 bounded groups; none is missed.
    """
    kept = [c for c in rows.columns if c != "g"]
    if "g" not in rows.columns:
        return rows.select(*kept, *[F.lit(0).alias(c) for c in ("i", "j", "side")])
    blocks = F.coalesce("g", F.lit(1))
    return (
        rows.withColumn("own", F.pmod(F.xxhash64(*spread), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            *kept,
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
        )
    )


def task_count(rows: DataFrame, keys: list[str], row_bytes: int) -> int:
    """Tasks that leave each about ``TASK_PAIRS`` comparisons and ``TASK_BYTES`` of rows."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("_rows"))
    total, squares = sizes.agg(F.sum("_rows"), F.sum(F.col("_rows") * F.col("_rows"))).first()
    wanted = max((squares or 0) / 2 / TASK_PAIRS, (total or 0) * row_bytes / TASK_BYTES)
    return int(min(max(wanted, rows.sparkSession.sparkContext.defaultParallelism), MOST_TASKS))
