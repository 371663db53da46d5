"""Connected components of a distributed list of links, with nothing collected."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.durable import durable


def smallest_reachable(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some links, and for each the smallest node that these links reach."""
    nodes, ends = np.unique(np.concatenate([one, two]), return_inverse=True)
    left, right = ends[: len(one)], ends[len(one) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the links of a batch by links from each node to the smallest it reaches: fewer, and equal in effect."""
    for batch in batches:
        nodes, low = smallest_reachable(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        kept = nodes != low
        yield pa.RecordBatch.from_arrays([pa.array(nodes[kept]), pa.array(low[kept])], ["node", "low"])


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node that has a link: the smallest node it reaches.

    ``links`` has two long columns; nulls and links of a node with itself say nothing and go.
    Without links the result is empty. Each round lets every node point to the smallest node among
    its neighbours and itself, first over larger neighbours, then over smaller ones, and keeps
    connectivity while paths shrink; the number of rounds grows with the logarithm of the longest
    path. Links are contracted inside each batch first, so a giant group becomes one
    star per task. Each round is written to the shared folder, so no lineage builds up.
    """
    a, b = (F.col(c) for c in links.columns[:2])
    links = links.where(a.isNotNull() & b.isNotNull() & (a != b)).select(a.alias("node"), b.alias("low"))
    tree = durable(links.mapInArrow(stars, "node long, low long").distinct(), "links")
    before = None
    while True:
        # Larger neighbours of a node, and the node, go to the smallest of its neighbours and itself.
        both = tree.union(tree.select("low", "node")).toDF("node", "near")
        least = both.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("low"))
        large = both.join(least, "node").where("near > node").select(F.col("near").alias("node"), "low")
        # Smaller neighbours of a node, and the node, go to the smallest of them.
        least = large.groupBy("node").agg(F.min("low").alias("least"))
        small = large.join(least, "node")
        linked = small.select("node", F.col("least").alias("low")).union(
            small.where("low > least").select(F.col("low").alias("node"), F.col("least").alias("low"))
        )
        tree = durable(linked.where("node > low").distinct(), "links")
        state = tree.agg(
            F.count("*"), F.sum(F.xxhash64("node", "low").cast("decimal(38,0)")), F.countDistinct("node")
        ).first()
        if state == before or state[0] == 0:
            break
        before = state
    roots = tree.select(F.col("low").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return tree.select("node", F.col("low").alias("component")).union(roots)
