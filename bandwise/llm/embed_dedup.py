"""Near-duplicate vectors: spherical k-means cells, blocked cosine products inside them, one kept per group.

Two unit vectors of cosine t are at most d = sqrt(2 - 2 t) apart. If their nearest centroids a and b differ,
the first is nearer to a, the second nearer to b, so along b - a they lie on either side of the
middle, and one of them is within d / 2 of it. So each vector also visits, as a guest, every cell whose
boundary with its own is within d / 2. That finds every link, whatever the centroids are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwise.durable import durable
from bandwise.llm.components import components, smallest_reachable

THRESHOLD = 0.93
#: Vectors the centroids are fitted on, at most; every vector is indexed.
FIT_ROWS = 20_000
MOST_CELLS = 256
ROUNDS = 8
BLOCK_ROWS = 1024
SLACK = 1e-9


def fit_centroids(vectors: np.ndarray, cells: int, seed: int = 11) -> np.ndarray:
    """Spherical k-means: unit centroids after a fixed number of rounds; an empty cell restarts at a random vector."""
    rng = np.random.default_rng(seed)
    centres = vectors[rng.choice(len(vectors), min(cells, len(vectors)), replace=False)]
    for _ in range(ROUNDS):
        nearest = (vectors @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, vectors)
        size = np.linalg.norm(sums, axis=1)
        lost = size < 1e-12
        sums[lost] = vectors[rng.integers(0, len(vectors), lost.sum())]
        centres = sums / np.where(lost, 1.0, size)[:, None]
    return np.unique(centres, axis=0)


def usable() -> Column:
    """Whether ``vec`` can link: label not null, no null or non-finite component, not zero. Never null."""
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    fine = F.col("label").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda v: v != 0)
    return F.coalesce(fine, F.lit(False))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as unit vectors in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def visits(unit: np.ndarray, centres: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each vector, and for all cells whether it goes there, its own included."""
    near = unit @ centres.T
    own = near.argmax(axis=1)
    apart = np.linalg.norm(centres[:, None, :] - centres[None, :, :], axis=2)
    beyond = near[np.arange(len(unit)), own][:, None] - near
    return own, beyond <= np.sqrt(2 - 2 * threshold) / 2 * apart[own] + SLACK


def in_cells(classes: DataFrame, dim: int, centres: np.ndarray, threshold: float) -> DataFrame:
    """``label, cell, home, id, weight, vec``: each class in its own cell (``home``) and as a guest in others."""
    shared = classes.sparkSession.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                rows = batch.slice(at, 2048)
                own, goes = visits(matrix(rows.column(3), dim), shared.value, threshold)
                row, cell = np.nonzero(goes)
                index = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0).take(index),
                        pa.array(cell.astype(np.int32)),
                        pa.array(own[row].astype(np.int32)),
                        *(rows.column(c).take(index) for c in (1, 2, 3)),
                    ],
                    ["label", "cell", "home", "id", "weight", "vec"],
                )

    label, vec = (classes.schema[c].dataType.simpleString() for c in ("label", "vec"))
    schema = f"label {label}, cell int, home int, id long, weight long, vec {vec}"
    return classes.select("label", "id", "weight", "vec").mapInArrow(assign, schema)


def compared(tasks: DataFrame, dim: int, centres: np.ndarray, threshold: float) -> DataFrame:
    """``id, other, weight`` from every block of home rows and every block of visiting rows of a cell.

    A row with null ``other`` adds ``weight`` to the links of ``id``; a row with null ``weight`` links two ids, and these
    links are contracted per block, so there are at most as many as vectors.
    """
    shared = tasks.sparkSession.sparkContext.broadcast(centres)

    def products(home: pa.Table, visiting: pa.Table) -> pa.RecordBatch:
        cell = home.column("cell")[0].as_py()
        y, x = matrix(home.column("vec").combine_chunks(), dim), matrix(visiting.column("vec").combine_chunks(), dim)
        ids_y, ids_x = home.column("id").to_numpy(), visiting.column("id").to_numpy()
        weight_y, weight_x = home.column("weight").to_numpy(), visiting.column("weight").to_numpy()
        home_x = visiting.column("home").to_numpy()
        linked = x @ y.T >= threshold
        linked &= ids_x[:, None] != ids_y[None, :]
        # A pair of two cells whose members both visit each other is counted in the smaller cell only.
        _, goes = visits(y, shared.value, threshold)
        foreign = home_x != cell
        linked &= ~(foreign[:, None] & goes.T[home_x] & (home_x < cell)[:, None])
        # Pairs of home rows are met twice, once from each side; a guest is met once and counts for both.
        count_x = linked @ weight_y
        count_y = (linked & foreign[:, None]).T @ weight_x
        # Negative numbers have no id: their links count, but stand in no component.
        one, two = np.nonzero(linked & (ids_x >= 0)[:, None] & (ids_y >= 0)[None, :])
        nodes, low = smallest_reachable(ids_x[one], ids_y[two]) if len(one) else (np.empty(0, np.int64),) * 2
        nodes, low = nodes[nodes != low], low[nodes != low]
        ids = np.concatenate([ids_x[count_x > 0], ids_y[count_y > 0], nodes])
        counts = np.concatenate([count_x[count_x > 0], count_y[count_y > 0]])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids),
                pa.concat_arrays([pa.nulls(len(counts), pa.int64()), pa.array(low, pa.int64())]),
                pa.concat_arrays([pa.array(counts.astype(np.int64)), pa.nulls(len(low), pa.int64())]),
            ],
            ["id", "other", "weight"],
        )

    def by_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held)
            side = rows.column("is_home").to_numpy(zero_copy_only=False).astype(bool)
            home, visiting = rows.filter(pa.array(side)), rows.filter(pa.array(~side))
            if home.num_rows and visiting.num_rows:
                yield products(home, visiting)

        key, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], axis=1)
            cuts = [0, *(np.nonzero((marks[1:] != marks[:-1]).any(axis=1))[0] + 1).tolist(), batch.num_rows]
            for i, j in zip(cuts, cuts[1:]):
                if key is not None and tuple(marks[i]) != key:
                    yield from flush(held)
                    held = []
                key = tuple(marks[i])
                held.append(batch.slice(i, j - i))
        if held:
            yield from flush(held)

    keys = ["label_key", "cell", "home_block", "visit_block"]
    rows = tasks.select(*keys, "is_home", "home", "id", "weight", "vec")
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(by_task, "id long, other long, weight long")


def blocks(placed: DataFrame) -> DataFrame:
    """Rows of ``placed`` for every block of home rows and block of visiting rows of the same label and cell.

    A cell of few rows is one task. A hot one is cut by hash into blocks of about ``BLOCK_ROWS`` on
    either side, and each row goes to the tasks of its block, so no task grows with the cell.
    """
    here = F.col("home") == F.col("cell")
    sizes = placed.groupBy("label_key", "cell").agg(F.sum(here.cast("long")).alias("n_home"), F.count("*").alias("n_visit"))
    cut = [F.ceil(F.greatest(F.col(f"n_{s}"), F.lit(1)) / BLOCK_ROWS).alias(f"{s}_blocks") for s in ("home", "visit")]
    rows = placed.join(sizes.where("n_home > 0 and n_visit > 1").select("label_key", "cell", *cut), ["label_key", "cell"])

    def dealt(own: str, other: str, is_home: bool) -> DataFrame:
        return rows.where(here if is_home else F.lit(True)).select(
            "*",
            F.pmod(F.xxhash64("id"), F.col(f"{own}_blocks")).cast("int").alias(f"{own}_block"),
            F.explode(F.sequence(F.lit(0), (F.col(f"{other}_blocks") - 1).cast("int"))).alias(f"{other}_block"),
            F.lit(is_home).alias("is_home"),
        )

    return dealt("home", "visit", True).unionByName(dealt("visit", "home", False))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``id, n_links, component_id, kept`` of every row of ``vectors`` (``id, label, vec``).

    Vectors of equal label and dimension link from a cosine of ``threshold`` on, in double precision. Null labels and
    vectors, zero vectors and those with null or non-finite components link with nothing and are kept. Equal
    vectors of a label are one class, which links all its members. Rows that repeat an id are rows of their own that
    link with each other if their vectors do; a null id gets a row with its links but stands in no component.
    """
    good = vectors.where(usable()).select("id", "label", "vec", F.size("vec").alias("dim"))
    members = durable(good, "vectors")
    classes = members.groupBy("label", "dim", "vec").agg(F.min("id").alias("least"), F.count("*").alias("weight"))
    # A number of its own for each class, also if ids repeat; negative without an id.
    number = F.monotonically_increasing_id()
    classes = durable(classes.withColumn("id", F.when(F.col("least").isNull(), -1 - number).otherwise(number)), "classes")
    links, counts = [], []
    for dim in sorted(r.dim for r in classes.select("dim").distinct().collect()):
        some = classes.where(F.col("dim") == dim)
        n = some.count()
        sample = some.orderBy(F.xxhash64("label", "vec"), "id").limit(fit_rows).select("vec").toArrow().column(0).combine_chunks()
        cells = max(1, min(MOST_CELLS, int(np.sqrt(n) / 4)))
        centres = fit_centroids(matrix(sample, dim), cells)
        placed = durable(in_cells(some, dim, centres, threshold).withColumn("label_key", F.xxhash64("label")), "cells")
        found = durable(compared(blocks(placed), dim, centres, threshold), "products")
        links.append(found.where("other is not null").select("id", "other"))
        counts.append(found.where("weight is not null").select("id", "weight"))
    if not links:
        return vectors.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    for other in links[1:]:
        links[0] = links[0].union(other)
    for other in counts[1:]:
        counts[0] = counts[0].union(other)
    group = components(links[0]).toDF("id", "component")
    named = group.join(classes.select("id", "least"), "id")
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    group = group.join(names, "component").select("id", "component_id")
    near = counts[0].groupBy("id").agg(F.sum("weight").alias("near"))
    about = classes.join(near, "id", "left").join(group, "id", "left").select(
        F.col("label").alias("label_of"),
        F.col("vec").alias("vec_of"),
        (F.coalesce("near", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component_id", "least").alias("component_id"),
    )
    of_members = members.join(about, (F.col("label") == F.col("label_of")) & (F.col("vec") == F.col("vec_of")), "left")
    linked = of_members.select("id", "n_links", "component_id")
    rest = vectors.where(~usable())
    alone = rest.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "id").alias("component_id")).withColumn(
        "kept", F.col("id").eqNullSafe(F.col("component_id"))
    )
