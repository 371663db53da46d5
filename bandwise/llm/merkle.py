"""A Merkle manifest of a table: a tree per group of rows, a tree over their roots, and a proof for every row.

Hashes are SHA-256 as lowercase hex text; an inner node is the hash of its children's hex digests
joined without a separator. Each tree folds its ordered nodes eight at a time (the last run may be
shorter, even one) until one node remains; a tree of one item is that item.

Proofs are made by the multiproof method: items are cut into blocks of ``8 ** BLOCK_LEVELS``
consecutive items, whose nodes up to that level can be derived from the block alone. For each block
Spark computes the union of node coordinates the block lacks (the other members of every run above
the block, up to the tree's root, then the runs of the tree over roots), fetches them with one
join, and one task per block derives the shared inner nodes and expands every item's proof from
them. No task holds more than a block and the ``8 * levels`` fetched digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwise.durable import broadcast_if_small, durable

#: Fixed values of the manifest's format: children per inner node, and the text of a null field.
FAN_OUT = 8
NULL_FIELD = "-"

#: Levels derived inside one block: 8 ** 3 = 512 items per task.
BLOCK_LEVELS = 3

PROOF_TYPE = "array<struct<left:string,right:string,inside:boolean>>"
PROOFS_SCHEMA = f"tree string, idx long, proof {PROOF_TYPE}"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count of the value's text, ``:``, and the text (integers in decimal)."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit(NULL_FIELD)).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*values: Column) -> Column:
    """The hash of the fields of a row, in the order given."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def tree_key(value: Column) -> Column:
    """A key that orders null first and strings bytewise after it, and is never null."""
    return F.when(value.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), value.cast("string")))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels(n: int) -> int:
    """Levels above the items of a tree of ``n`` items."""
    count, found = n, 0
    while count > 1:
        count, found = -(-count // FAN_OUT), found + 1
    return found


def ranked(items: DataFrame, order: list[Column]) -> DataFrame:
    """``items`` (with ``tree``) plus ``idx``, their place in their tree by ``order``, and ``n``, the tree's size.

    A range-partitioned sort, ids that grow along it, and offsets per partition: no window over a
    whole tree, so a tree of a third of all rows is still spread over all tasks. The number of
    partitions, not of rows, goes through the driver.
    """
    placed = durable(items.orderBy(F.col("tree"), *order).withColumn("_pos", F.monotonically_increasing_id()), "ranked")
    part, inside = F.shiftright("_pos", 33), F.col("_pos").bitwiseAND((1 << 33) - 1)
    counts = sorted(tuple(r) for r in placed.groupBy(part.alias("part")).count().collect())
    offsets, total = {}, 0
    for at, count in counts:
        offsets[at], total = total, total + count
    offset = F.lit(0).cast("long")
    if offsets:
        offset = F.element_at(F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv]), part)
    placed = placed.withColumn("_g", offset + inside).drop("_pos")
    starts = placed.groupBy("tree").agg(F.min("_g").alias("_start"), F.count(F.lit(1)).alias("n"))
    found = starts.count()
    starts = broadcast_if_small(durable(starts, "tree-starts"), found)
    return placed.join(starts, "tree").withColumn("idx", F.col("_g") - F.col("_start")).drop("_g", "_start")


def _block(idx: Column) -> Column:
    return F.floor(idx / FAN_OUT**BLOCK_LEVELS).cast("long")


def _fold_block(rows: pd.DataFrame) -> Iterator[list[str]]:
    """Nodes of a block, level by level, while its tree still has more than one node at that level."""
    rows = rows.sort_values("idx")
    nodes, top = list(rows["digest"]), min(BLOCK_LEVELS, levels(int(rows["n"].iloc[0])))
    yield nodes
    for _ in range(top):
        nodes = [sha("".join(nodes[at : at + FAN_OUT])) for at in range(0, len(nodes), FAN_OUT)]
        yield nodes


def block_roots(rows: pd.DataFrame) -> pd.DataFrame:
    *_, top = _fold_block(rows)
    first = rows.iloc[0]
    level = min(BLOCK_LEVELS, levels(int(first["n"])))
    return pd.DataFrame({"tree": [first["tree"]], "n": [first["n"]], "level": [level], "idx": [first["blk"]], "digest": [top[0]]})


def block_proofs(rows: pd.DataFrame, fetched: pd.DataFrame) -> pd.DataFrame:
    """Every item's proof: its run's others at each level inside the block, then the fetched levels."""
    if rows.empty:
        return pd.DataFrame({"tree": [], "idx": [], "proof": []})
    rows = rows.sort_values("idx")
    built = list(_fold_block(rows))
    first_idx = int(rows["idx"].iloc[0])
    upper = [] if fetched.empty else [
        {"left": r.left, "right": r.right, "inside": bool(r.inside)} for r in fetched.sort_values("level").itertuples()
    ]
    proofs = []
    for idx in rows["idx"]:
        proof, at = [], int(idx) - first_idx
        for nodes in built[:-1]:
            start = at - at % FAN_OUT
            run = nodes[start : start + FAN_OUT]
            proof.append({"left": "".join(run[: at - start]), "right": "".join(run[at - start + 1 :]), "inside": True})
            at //= FAN_OUT
        proofs.append(proof + upper)
    return pd.DataFrame({"tree": rows["tree"].to_numpy(), "idx": rows["idx"].to_numpy(), "proof": proofs})


def _runs(nodes: DataFrame, level: int) -> DataFrame:
    """Parents of nodes at ``level`` whose tree has more than one node there, with their children in order."""
    many = nodes.where(F.col("n") > FAN_OUT**level)
    grouped = many.groupBy("tree", "n", F.floor(F.col("idx") / FAN_OUT).cast("long").alias("idx")).agg(
        F.array_sort(F.collect_list(F.struct("idx", "digest"))).alias("children")
    )
    return grouped.select(
        "tree", "n", F.lit(level + 1).alias("level"), "idx", F.col("children.digest").alias("children"),
        F.sha2(F.array_join("children.digest", ""), 256).alias("digest"),
    )


def tree_proofs(items: DataFrame, outer: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Proofs of ranked items ``tree, idx, n, digest``, and the root of each tree, ``tree, root``.

    ``outer`` (``tree, proof``) continues every proof of a tree above its root, marked as not inside.
    """
    blocked = items.withColumn("blk", _block(F.col("idx")))
    roots_schema = "tree string, n long, level int, idx long, digest string"
    nodes = durable(blocked.groupBy("tree", "blk").applyInPandas(block_roots, roots_schema), "block-roots")
    blocks = nodes.select("tree", "n", F.col("idx").alias("blk"))
    top = nodes.agg(F.max("n")).first()[0]
    runs, roots = [], [nodes.where(F.col("n") <= FAN_OUT**BLOCK_LEVELS)]
    for level in range(BLOCK_LEVELS, levels(top or 0)):
        parents = durable(_runs(nodes, level), f"level-{level + 1}")
        runs.append(parents)
        roots.append(parents.where(F.col("n") <= FAN_OUT ** (level + 1)))
        nodes = parents.select("tree", "n", "level", "idx", "digest")
    tree_roots = roots[0].select("tree", F.col("digest").alias("root"))
    for more in roots[1:]:
        tree_roots = tree_roots.unionByName(more.select("tree", F.col("digest").alias("root")))

    # The coordinates a block lacks: at each level from the block's up to its tree's root, the run of its ancestor.
    needs = blocks
    above = F.sequence(F.lit(BLOCK_LEVELS), F.greatest(F.lit(BLOCK_LEVELS), F.lit(levels(top or 0)) - 1))
    needs = needs.select("tree", "blk", "n", F.explode(above).alias("level")).where(F.col("n") > F.pow(F.lit(FAN_OUT), F.col("level")))
    needs = needs.select(
        "tree", "blk", "level",
        F.floor(F.col("blk") / F.pow(F.lit(FAN_OUT), F.col("level") - BLOCK_LEVELS + 1)).cast("long").alias("parent"),
        F.pmod(F.floor(F.col("blk") / F.pow(F.lit(FAN_OUT), F.col("level") - BLOCK_LEVELS)), F.lit(FAN_OUT)).cast("int").alias("at"),
    )
    fetched = needs.limit(0).select("tree", "blk", "level", F.lit("").alias("left"), F.lit("").alias("right"))
    if runs:
        every_run = runs[0].select("tree", "level", "idx", "children")
        for more in runs[1:]:
            every_run = every_run.unionByName(more.select("tree", "level", "idx", "children"))
        fetched = needs.join(
            every_run.withColumnsRenamed({"idx": "parent"}).withColumn("level", F.col("level") - 1), ["tree", "level", "parent"]
        ).select(
            "tree", "blk", "level",
            F.array_join(F.slice("children", 1, F.col("at")), "").alias("left"),
            F.array_join(F.slice("children", F.col("at") + 2, FAN_OUT), "").alias("right"),
        )
    fetched = fetched.withColumn("inside", F.lit(True))
    if outer is not None:
        trees = blocks.select("tree", "blk")
        found = outer.count()
        beyond = trees.join(broadcast_if_small(outer, found), "tree").select(
            "tree", "blk", F.posexplode("proof").alias("at", "step")
        )
        fetched = fetched.unionByName(
            beyond.select(
                "tree", "blk", (F.lit(1000) + F.col("at")).cast("int").alias("level"),
                F.col("step.left").alias("left"), F.col("step.right").alias("right"), F.lit(False).alias("inside"),
            )
        )
    proofs = blocked.select("tree", "blk", "idx", "n", "digest").groupBy("tree", "blk").cogroup(
        fetched.groupBy("tree", "blk")
    ).applyInPandas(block_proofs, PROOFS_SCHEMA)
    return proofs, tree_roots


def fold(start: Column, proof: Column, inside_only: bool = False) -> Column:
    """The node reached from ``start`` by hashing it with the others of its run, level by level."""
    steps = F.filter(proof, lambda s: s["inside"]) if inside_only else proof
    return F.aggregate(steps, start, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def manifest(docs: DataFrame, tampered_text: Column | None = None) -> DataFrame:
    """A row per document: ``doc_id, leaf, subroot, root, proof, folded_root, verified``.

    Leaves hash ``doc_id, source, lang, n_chars, text``. Documents form one tree per ``lang``
    (null is a language of its own), leaves by ascending ``doc_id`` (null first; equal ids by
    leaf); the trees' roots (subroots), by ``lang``, null first, then UTF-8 bytewise, form the
    tree of the root. ``proof`` lists, from leaf to root, the others of each run left and right of
    the path, ``inside`` while within the language's tree. ``folded_root`` folds the leaf of
    ``tampered_text`` (by default the text) with the original proof; ``verified`` says it equals
    the root. Repeated rows are separate leaves; an empty table gives no row; other columns are
    not read and not returned.
    """
    text = F.col("text") if tampered_text is None else tampered_text
    fields = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars")]
    rows = docs.select(
        "doc_id", tree_key(F.col("lang")).alias("tree"),
        leaf_hash(*fields, F.col("text")).alias("digest"), leaf_hash(*fields, text).alias("tampered"),
    )
    leaves = durable(ranked(rows, [F.col("doc_id").asc_nulls_first(), F.col("digest")]), "leaves")
    subroots = leaves.select("tree").distinct().count()
    lang_roots = tree_proofs(leaves)[1]
    # The tree over the subroots is a tree of one key; its items are the subroots by language.
    top_items = ranked(lang_roots.select(F.col("tree").alias("lang_tree"), F.lit("").alias("tree"), F.col("root").alias("digest")), [F.col("lang_tree")])
    top_proofs, _ = tree_proofs(top_items)
    outer = top_items.join(top_proofs, ["tree", "idx"]).select(F.col("lang_tree").alias("tree"), F.col("proof"))
    outer = broadcast_if_small(durable(outer, "outer-proofs"), subroots)
    proofs, _ = tree_proofs(leaves, outer)
    done = leaves.join(proofs, ["tree", "idx"])
    return done.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        fold(F.col("digest"), F.col("proof"), inside_only=True).alias("subroot"),
        fold(F.col("digest"), F.col("proof")).alias("root"),
        "proof",
        fold(F.col("tampered"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
