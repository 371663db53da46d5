"""The parameter grid: dataset size, signature bits, band count and threshold."""

from __future__ import annotations

import time
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.durable import durable, release, written_tables
from bandwise.functions.bits import prefix_signature
from bandwise.functions.simhash import vector_length, with_simhash
from bandwise.plans.quality import NO_ID, exact_quality
from bandwise.sources.sinks import finished_sizes, read_quality, write_quality
from bandwise.sources.vectors import prefix_cutoff

def sweep(
    vectors: DataFrame,
    ns: Iterable[int],
    ms: Iterable[int] = (64,),
    bs: Iterable[int] = (4, 8),
    ks: Iterable[int] = (0, 2, 4, 8),
    seed: int = 42,
    dim: int | None = None,
) -> DataFrame:
    """Quality for every (n, m, b, k) in one plan per m: ``n, b, m, k`` and the measures.

    ``n`` stands for the n rows with the smallest ids, whatever the ids are; the cut-off ids are found by counting.
    Pairs of a prefix are those pairs of the largest one whose ids both lie in it, so all sizes share one
    signature, banding and pairing run.
    """
    ns, ms, bs, ks = sorted(set(ns)), list(ms), list(bs), list(ks)
    vectors = vectors.select("doc_id", "vec").where(F.col("vec").isNotNull())
    cutoffs = {n: prefix_cutoff(vectors, n) if n > 0 else NO_ID for n in ns}
    last = cutoffs[ns[-1]]
    vectors = vectors if last is None else vectors.where(F.col("doc_id") <= last)
    signed = with_simhash(vectors, max(ms), seed, dim or vector_length(vectors))
    signed = durable(signed.select("doc_id", "vec", "sig"), "signatures")
    tables = []
    for m in ms:
        sig = F.col("sig") if m == max(ms) else prefix_signature("sig", max(ms), m).alias("sig")
        tables.append(exact_quality(signed.select("doc_id", "vec", sig), ks, m, bs, cutoffs))
    columns = ["n", "b", "m", "k", "num_docs", "num_pairs", "mean_cosine", "mean_hamming", "cosine_hamming"]
    return reduce(DataFrame.unionByName, tables).select(F.col("n").cast("long").alias("n"), *columns[1:])


def run_sweep(vectors: DataFrame, ns: Iterable[int], path: str, fmt: str = "parquet", **grid) -> DataFrame:
    """Sweep one size after another, timing each and appending it to the table at ``path``.

    Sizes already in the table are skipped, so an interrupted run continues where it
    stopped. Adds ``time_sec``, the wall time of the size spread over its rows. Takes
    the keyword arguments of :func:`sweep`.
    """
    spark = vectors.sparkSession
    done = finished_sizes(spark, path, fmt)
    for n in sorted(set(ns)):
        if n in done:
            continue
        started, before = time.perf_counter(), set(written_tables())
        rows = sweep(vectors, [n], **grid).toPandas()
        rows["time_sec"] = (time.perf_counter() - started) / max(len(rows), 1)
        write_quality(spark.createDataFrame(rows), path, fmt)
        release([table for table in written_tables() if table not in before])
    return read_quality(spark, path, fmt)
