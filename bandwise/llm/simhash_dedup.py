"""SimHash of word shingles, and links of fingerprints by meeting in the middle.

Two 64-bit fingerprints that differ in at most three bits differ in at most one bit (half the radius,
rounded down) of one of their two 32-bit halves. So every fingerprint emits, for each half, the
half and all its variants within one bit, 66 in all. A half as it is meets the variants of others:
that is a shuffle on variants; colliding fingerprints are then compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.durable import durable_alone
from bandwise.llm.common import slices
from bandwise.llm.components import components, smallest_reachable

RADIUS = 3
SHINGLE = 3
SEED = 42
GROUP_ROWS = 4096
BLOCK = 1024


def fingerprint(text: str | None, words_per_shingle: int = SHINGLE) -> int:
    """64 bits; each is 1 if it is set in over half of the hashes of all shingles, repeats included.

    A-Z are lower-cased and words end at ASCII white space. With fewer words than a shingle has, the
    whole sequence is one shingle; without any word the fingerprint is zero.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    width = min(words_per_shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    stops = (ends[width - 1 :] - 1).tolist()
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[i:j], SEED) for i, j in zip(starts.tolist(), stops)])
    counts = np.zeros(64, np.int64)
    raw = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    for at in range(0, len(raw), 1 << 16):
        counts += np.unpackbits(raw[at : at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(raw)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, words_per_shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with ``fingerprint``, a long with the 64 bits. Null and wordless texts get zero."""

    @F.arrow_udf("long")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = [fingerprint(x, words_per_shingle) for x in batch.to_pylist()]
            yield pa.array(np.array(values, np.uint64).view(np.int64))

    return docs.withColumn("fingerprint", simhash("text"))


def near_links(prints: np.ndarray, own: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all fingerprints of a group which differ in at most ``radius`` bits.

    Blocks of the unmodified ones (``own``) are compared with blocks of all; what a block links is
    contracted at once, so there are never more links than fingerprints in two blocks.
    """
    ones, twos = [], []
    held = prints[own]
    for i in range(0, len(held), BLOCK):
        a = held[i : i + BLOCK]
        for j in range(0, len(prints), BLOCK):
            b = prints[j : j + BLOCK]
            left, right = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)
            left, right = a[left], b[right]
            apart = left != right
            if apart.any():
                nodes, low = smallest_reachable(left[apart].view(np.int64), right[apart].view(np.int64))
                ones.append(nodes[nodes != low])
                twos.append(low[nodes != low])
    if not ones:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(ones), np.concatenate(twos)


def variants(prints: DataFrame, part: str, bits: int, keys: list[str], name: str) -> DataFrame:
    """Rows of ``prints`` by ``part`` (an SQL number of ``bits`` bits) and by each of its one-bit variants."""
    flips = ", ".join(f"{1 << b}L" for b in range(bits))
    return prints.select(*keys, "fingerprint", "own", F.expr(f"explode(array(0L, {flips}))").alias("flip")).select(
        *keys,
        F.expr(f"({part}) ^ flip").alias(name),
        "fingerprint",
        (F.col("own") & (F.col("flip") == 0)).alias("own"),
    )


def contract(groups: DataFrame, keys: list[str], radius: int) -> DataFrame:
    """``node, low`` links of all groups of equal ``keys``; groups are contiguous in sorted partitions."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(prints: list[np.ndarray], own: list[np.ndarray]) -> pa.RecordBatch:
            one, two = near_links(np.concatenate(prints), np.concatenate(own), radius)
            return pa.RecordBatch.from_arrays([pa.array(one), pa.array(two)], ["node", "low"])

        key, prints, own = None, [], []
        for batch in batches:
            marks = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(keys))]
            values = batch.column(len(keys)).to_numpy().view(np.uint64)
            mine = batch.column(len(keys) + 1).to_numpy(zero_copy_only=False).astype(bool)
            changed = np.any([m[1:] != m[:-1] for m in marks], axis=0)
            cuts = [0, *(np.nonzero(changed)[0] + 1).tolist(), batch.num_rows]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                here = tuple(m[i] for m in marks)
                if here != key:
                    if sum(map(len, prints)) > 1:
                        yield flush(prints, own)
                    key, prints, own = here, [], []
                prints.append(values[i:j])
                own.append(mine[i:j])
        if sum(map(len, prints)) > 1:
            yield flush(prints, own)

    rows = groups.repartition(*keys).sortWithinPartitions(*keys).select(*keys, "fingerprint", "own")
    return rows.mapInArrow(linked, "node long, low long")


def fingerprint_links(prints: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links that join all ``fingerprint`` values within three differing bits, each value given once.

    A meeting of more than ``group_rows`` fingerprints is met again in each quarter of the other
    half, where one of the two quarters again differs in at most one bit. 48 of 64 bits are then
    fixed up to two flips, which bounds a group whatever the size of the table.
    """
    base = prints.select("fingerprint", F.lit(True).alias("own"))
    halves = None
    for half in (0, 1):
        part = f"shiftrightunsigned(fingerprint, {32 * half}) & 4294967295L"
        keyed = variants(base, part, 32, [], "met").select(F.lit(half).alias("half"), "met", "fingerprint", "own")
        halves = keyed if halves is None else halves.union(keyed)
    # A meeting needs an unmodified half and one more row; most variants meet nobody.
    sizes = halves.groupBy("half", "met").agg(F.count("*").alias("n"), F.max("own").alias("met_own"))
    sizes = sizes.where("n > 1 and met_own").drop("met_own")
    # Spark sizes a table as if explode made no more rows; a side of this join that it deems small enough to send whole is not.
    met = durable_alone(halves.join(sizes.hint("merge"), ["half", "met"]), "meetings")
    usual = met.where(F.col("n") <= group_rows).drop("n")
    links = contract(usual, ["half", "met"], RADIUS)
    hot = met.where(F.col("n") > group_rows).drop("n")
    again = None
    for quarter in (0, 1):
        part = f"shiftrightunsigned(fingerprint, 32 * (1 - half) + {16 * quarter}) & 65535L"
        keyed = variants(hot, part, 16, ["half", "met"], "again").withColumn("quarter", F.lit(quarter))
        again = keyed if again is None else again.unionByName(keyed)
    return links.union(contract(again, ["half", "met", "quarter", "again"], RADIUS))


def with_components(docs: DataFrame, words_per_shingle: int = SHINGLE, keep_text: bool = False) -> DataFrame:
    """``docs`` with ``fingerprint`` (of the text, whatever a column of that name holds), ``component`` (one number per group) and ``component_id``, the smallest
    ``doc_id`` of the group.

    Documents link at three or fewer differing bits; those without words have fingerprint zero and are
    linked like any other. Equal fingerprints are one node, so copies cost one row. A null ``doc_id``
    keeps its row; a group without any id has a null ``component_id``. Rows that share a ``doc_id``
    are documents of their own. ``docs`` of no other columns lose their text unless ``keep_text``.
    """
    prints = with_fingerprint(docs.drop("fingerprint"), words_per_shingle)
    ids = durable_alone(prints.select("doc_id", "fingerprint"), "prints")
    classes = durable_alone(ids.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "classes")
    found = components(fingerprint_links(classes.select("fingerprint"))).toDF("fingerprint", "component")
    groups = classes.join(found, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))
    groups = durable_alone(groups, "components")
    named = groups.groupBy("component").agg(F.min("first").alias("component_id"))
    named = groups.join(named, "component").select("fingerprint", "component", "component_id")
    if not keep_text and set(docs.columns) <= {"doc_id", "text"}:
        return ids.join(named, "fingerprint")
    return prints.join(named, "fingerprint")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document, see ``with_components``."""
    return with_components(docs.select("doc_id", "text")).select("doc_id", "fingerprint", "component_id")
