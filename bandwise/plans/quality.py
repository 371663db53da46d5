"""Quality tables: documents, pairs and mean similarities at each Hamming threshold."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwise.durable import BROADCAST_BYTES, durable
from bandwise.functions.cosine import angle_cosine, dot
from bandwise.functions.simhash import l2_norm
from bandwise.operators.meeting import Meeting, met, met_blocks, tile_dots
from bandwise.operators.pairs import BLOCK_ROWS, banded_blocks, pair_count

ANY_ID, NO_ID = (1 << 63) - 1, -(1 << 63)
MEASURES = ["num_docs", "num_pairs", "mean_cosine", "mean_hamming", "cosine_hamming"]


def quality_by_k(
    pairs: DataFrame, ks: Iterable[int], m: int, bs: Iterable[int], ns: Iterable[int] | None = None
) -> DataFrame:
    """Quality of scored pairs ``b, d1, d2, h, cos`` at each ``k``: one row per (n, b, k).

    Thresholds without pairs give zeros. With ``ns`` the pairs must also have ``n``.
    """
    grid = {"b": list(bs)} if ns is None else {"n": list(ns), "b": list(bs)}
    weighted = pairs.select(
        *grid,
        F.col("d1").alias("left_key"),
        F.col("d2").alias("right_key"),
        F.lit(1).cast("long").alias("left_docs"),
        F.lit(1).cast("long").alias("right_docs"),
        "h",
        F.lit(1).cast("decimal(38,0)").alias("pairs"),
        F.coalesce("cos", F.lit(0.0)).alias("sum_cos"),
        F.col("cos").isNotNull().cast("double").alias("n_cos"),
    )
    return weighted_quality(weighted, ks, m, grid)


def similar_docs_by_k(pairs: DataFrame, ks: Iterable[int], m: int, bs: Iterable[int]) -> DataFrame:
    """Distinct documents in pairs of at most k differing bits: ``b, k, num_docs``."""
    return quality_by_k(pairs.withColumn("cos", F.lit(None).cast("double")), ks, m, bs).select("b", "k", "num_docs")


def part(key: Column, dist: Column, docs: Column, pairs: Column, sum_cos: Column, n_cos: Column) -> Column:
    """What a pair or a sum adds to one end or one distance."""
    named = {"key": key, "dist": dist, "docs": docs, "pairs": pairs, "sum_cos": sum_cos, "n_cos": n_cos}
    return F.struct(*[value.alias(name) for name, value in named.items()])


def weighted_quality(weighted: DataFrame, ks: Iterable[int], m: int, grid: dict[str, list[int]]) -> DataFrame:
    """Per-threshold statistics of weighted pairs in one pass.

    Each pair gives a row for either end and one for its distance. A single
    aggregation, combined before the shuffle, then leaves the least distance of each
    end and a histogram of distances; both are small against the pairs, and every
    threshold reads from them. No pass per threshold and no distinct over pairs.
    """
    group = list(grid)
    zero, no_docs, no_pairs = F.lit(0.0), F.lit(0).cast("long"), F.lit(0).cast("decimal(38,0)")
    no_key = F.lit(None).cast(weighted.schema["left_key"].dataType)

    ends = [
        part(F.col(f"{side}_key"), F.lit(-1), F.col(f"{side}_docs"), no_pairs, zero, zero) for side in ("left", "right")
    ]
    distance = part(no_key, F.col("h"), no_docs, F.col("pairs"), F.col("sum_cos"), F.col("n_cos"))
    parts = weighted.select(*group, "h", F.inline(F.array(*ends, distance)))
    return threshold_quality(combined(parts, group), ks, m, grid)


def combined(parts: DataFrame, group: list[str]) -> DataFrame:
    """One row per end (``key``) and per distance (``dist``): least ``h`` and ``docs`` of an end, sums of a distance."""
    return parts.groupBy(*group, "key", "dist").agg(
        F.min("h").alias("h"),
        F.max("docs").alias("docs"),
        *[F.sum(c).alias(c) for c in ("pairs", "sum_cos", "n_cos")],
    )


def threshold_quality(ends_and_distances: DataFrame, ks: Iterable[int], m: int, grid: dict[str, list[int]]) -> DataFrame:
    """The measures at each threshold from :func:`combined` rows."""
    group, ks, weight = list(grid), list(ks), F.col("pairs").cast("double")
    zero = F.lit(0.0)
    stats = (
        ends_and_distances.select("*", F.explode(F.lit(ks)).alias("k"))
        .where(F.col("h") <= F.col("k"))
        .groupBy(*group, "k")
        .agg(
            F.sum("docs").alias("docs"),
            F.sum("pairs").alias("pairs"),
            F.try_divide(F.sum("sum_cos"), F.sum("n_cos")).alias("mean_cosine"),
            F.try_divide(F.sum(weight * F.col("h")), F.sum(weight)).alias("mean_hamming"),
            F.try_divide(F.sum(weight * angle_cosine(F.col("h"), m)), F.sum(weight)).alias("cosine_hamming"),
        )
    )
    cells = grid_rows(ends_and_distances, {**grid, "k": ks})
    found = F.col("pairs").isNotNull()
    return cells.join(stats, [*group, "k"], "left").select(
        *group,
        F.lit(m).alias("m"),
        "k",
        F.coalesce(F.col("docs").cast("long"), F.lit(0)).alias("num_docs"),
        F.coalesce(F.col("pairs").cast("long"), F.lit(0)).alias("num_pairs"),
        *[F.when(found, F.col(c)).otherwise(zero).alias(c) for c in MEASURES[2:]],
    )


def grid_rows(like: DataFrame, grid: dict[str, list[int]]) -> DataFrame:
    """All combinations of the parameter lists."""
    rows = like.sparkSession.range(1).select()
    for name, values in grid.items():
        rows = rows.select("*", F.explode(F.lit(values)).alias(name))
    return rows


def exact_quality(
    signed: DataFrame, ks: Iterable[int], m: int, bs: Iterable[int], cutoffs: dict[int, int | None]
) -> DataFrame:
    """Quality of ``signed`` (``doc_id, vec, sig``) over the first n rows, for every n at once, without listing pairs.

    ``cutoffs`` has the greatest id of each n; None stands for the whole table.

    Documents with the same signature that enter at the same n count as one group. Between two groups the
    number of pairs is the product of their sizes and the sum of cosines is the dot product of their summed
    unit vectors, so copies, even a third of the table, cost one row. Groups meet in blocks of bounded size;
    the task that holds two blocks gives only sums by n, b and distance and the least distance of each group.
    A pair of groups enters with the later one, so what is counted once holds for every n from there on.
    """
    ks, bs, ns = list(ks), list(bs), sorted(cutoffs)
    sums = durable(unit_sums(signed, cutoffs, ns), "unit-sums")
    dim = sums.agg(F.max(F.size("total"))).first()[0] or 0
    block_rows = max(2, min(BLOCK_ROWS, BROADCAST_BYTES // (8 * dim or 1)))
    blocks, keys, tasks, how = banded_blocks(sums, m, bs, max(ks), ["sig", "step"], block_rows, 64 + 8 * dim)
    counted = met(blocks, keys, tasks, block_measures(keys, how, len(ns)), MEASURED)
    # Documents of one group pair with each other.
    within = sums.where("docs > 1").select(F.explode(F.lit(bs)).alias("b"), "step", "row", "docs", "units", dot(F.col("total"), F.col("total")).alias("product"))
    within = within.select("b", "step", F.lit(0).alias("h"), F.inline(F.array(
        part(F.col("row"), F.lit(-1), F.col("docs"), F.lit(0).cast("decimal(38,0)"), F.lit(0.0), F.lit(0.0)),
        part(F.lit(None).cast("long"), F.lit(0), F.lit(0).cast("long"), pair_count("docs"),
             (F.col("product") - F.col("units")) / 2, pair_count("units").cast("double")),
    )))
    counted = counted.withColumn("pairs", F.col("pairs").cast("decimal(38,0)")).unionByName(within)
    by_step = combined(counted, ["b", "step"])
    reached = F.explode(F.slice(F.lit(ns).cast("array<long>"), F.col("step") + 1, len(ns))).alias("n")
    by_n = by_step.select("b", reached, "key", "dist", "h", "docs", "pairs", "sum_cos", "n_cos")
    return threshold_quality(combined(by_n, ["n", "b"]), ks, m, {"n": ns, "b": bs})


def block_measures(keys: list[str], how: Meeting, steps: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A visitor of blocks that gives ``MEASURED``: sums by step, b and distance, and each group's least distance by step and b."""
    cells, far = how.m + 1, how.m + 1

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for left, right, tiles in met_blocks(batches, keys, how):
            sides = [left] if left is right else [left, right]
            offsets = {id(side): at for side, at in zip(sides, (0, len(left["sig"])))}
            rows = {name: np.concatenate([side[name] for side in sides]) for name in ("row", "docs")}
            size = len(rows["row"])
            least = np.full(len(how.bs) * steps * size, far, np.int64)
            pairs = np.zeros(len(how.bs) * steps * cells, np.int64)
            sum_cos, n_cos = np.zeros(len(pairs)), np.zeros(len(pairs))
            for one, two, h, shared in tiles:
                step = np.maximum(left["step"][one], right["step"][two]).astype(np.int64)
                both = left["docs"][one] * right["docs"][two]
                units = (left["units"][one] * right["units"][two]).astype(np.float64)
                product = tile_dots(left["total"], right["total"], one, two)
                for at, met_in in enumerate(shared):
                    chosen = slice(None) if met_in.all() else np.flatnonzero(met_in)
                    place = at * steps + step[chosen]
                    cell = place * cells + h[chosen]
                    weights = both[chosen]
                    if len(weights) and weights.max() > 1:
                        np.add.at(pairs, cell, weights)
                    else:
                        pairs += np.bincount(cell, minlength=len(pairs))
                    sum_cos += np.bincount(cell, product[chosen], len(pairs))
                    n_cos += np.bincount(cell, units[chosen], len(pairs))
                    for side, ends in ((left, one), (right, two)):
                        np.minimum.at(least, place * size + ends[chosen] + offsets[id(side)], h[chosen])
            at = np.flatnonzero(least < far)
            place, end = np.divmod(at, size)
            yield measured(how.bs, steps, place, rows["row"][end], np.full(len(at), -1), least[at], rows["docs"][end])
            at = np.flatnonzero(pairs)
            place, h = np.divmod(at, cells)
            yield measured(how.bs, steps, place, None, h, h, np.zeros(len(at), np.int64), pairs[at], sum_cos[at], n_cos[at])

    return visit


MEASURED = "b int, step int, key long, dist int, h int, docs long, pairs long, sum_cos double, n_cos double"


def measured(bs: list[int], steps: int, place: np.ndarray, key, dist, h, docs, pairs=None, sum_cos=None, n_cos=None) -> pa.RecordBatch:
    """Rows of ``MEASURED``; ``place`` numbers b and step, and sums not given are zero."""
    size = len(place)
    none = np.zeros(size)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.array(bs)[place // steps], pa.int32()),
            pa.array(place % steps, pa.int32()),
            pa.nulls(size, pa.int64()) if key is None else pa.array(key, pa.int64()),
            pa.array(dist, pa.int32()),
            pa.array(h, pa.int32()),
            pa.array(docs, pa.int64()),
            pa.array(none.astype(np.int64) if pairs is None else pairs),
            pa.array(none if sum_cos is None else sum_cos),
            pa.array(none if n_cos is None else n_cos),
        ],
        ["b", "step", "key", "dist", "h", "docs", "pairs", "sum_cos", "n_cos"],
    )


def unit_sums(signed: DataFrame, cutoffs: dict[int, int | None], ns: list[int]) -> DataFrame:
    """Per signature and place in ``ns`` of the first n it enters with (``step``): documents, documents of non-zero length,
    summed unit vectors, and a number ``row``.

    Partial sums are formed before the shuffle, so a signature held by many sends one row per task.
    """
    norm = l2_norm("vec")
    unit = F.transform("vec", lambda x: x.cast("double") * F.col("inverse"))
    steps = [F.when(F.col("doc_id") <= (ANY_ID if cutoffs[n] is None else cutoffs[n]), F.lit(at)) for at, n in enumerate(ns)]
    return (
        signed.where(F.col("sig").isNotNull())
        .select("sig", "vec", F.coalesce(*steps).alias("step"), F.coalesce(F.try_divide(F.lit(1.0), norm), F.lit(0.0)).alias("inverse"))
        .where(F.col("step").isNotNull())
        .select("sig", "step", array_to_vector(unit).alias("unit"), (F.col("inverse") > 0).cast("long").alias("is_unit"))
        .groupBy("sig", "step")
        .agg(
            F.count(F.lit(1)).alias("docs"),
            F.sum("is_unit").alias("units"),
            Summarizer.sum(F.col("unit")).alias("total"),
        )
        .withColumn("total", vector_to_array("total"))
        .withColumn("row", F.monotonically_increasing_id())
    )
