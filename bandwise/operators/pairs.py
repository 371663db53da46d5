"""Candidate pairs: documents that share at least one band."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwise.durable import broadcast_if_small, durable
from bandwise.functions.bits import WORD_BITS, band_width, generating_counts, piece_array
from bandwise.functions.cosine import cosine
from bandwise.operators.banding import BUCKET, band_keys
from bandwise.operators.buckets import block_pairs, hot_keys, task_count
from bandwise.operators.meeting import Meeting, met, met_pairs, shared_lists, tile_dots

BLOCK_ROWS = 16_384
REFINE_BLOCKS = 2
BLOCK_BYTES = 64 * 1024 * 1024
MEMBER_ROWS = 10_000
SUBSET_BANDS = 8
#: Sets counted by one task of :func:`agreeing_counts`.
TASK_SETS = 2_000_000
PIECE_KEYS = ["piece", "piece_val"]


def candidate_pairs(signatures: DataFrame, m: int, bs: Iterable[int], max_h: int | None = None) -> DataFrame:
    """Distinct pairs sharing a band: ``b, d1, d2, h`` with ``d1 < d2``.

    ``max_h`` keeps only pairs of at most that Hamming distance. With the vectors of :func:`with_own_vectors`, also ``cos``.
    """
    pairs = document_pairs(signatures, m, list(bs), max_h)
    return pairs.select(F.explode("bs").alias("b"), *[c for c in pairs.columns if c != "bs"])


def candidate_count(signatures: DataFrame, m: int, bs: Iterable[int], subset_bands: int = SUBSET_BANDS) -> DataFrame:
    """Number of candidate pairs per band count, ``b, candidates``; zero where there is none.

    Copies are counted by group size, in whole numbers, and never paired one by one.
    Band counts up to ``subset_bands`` are counted without forming a pair, by
    inclusion-exclusion over sets of bands (:func:`agreeing_counts`): 2^b - 1 rows per
    distinct signature. Larger band counts, where that grows faster than the pairs, are counted
    by comparing signatures block by block; no pair leaves its task.
    """
    bs = list(bs)
    signatures = durable(signatures.select("doc_id", "sig"), "signatures").where(F.col("sig").isNotNull())
    groups = signature_groups(signatures)
    parts = []
    by_sets = [b for b in bs if b <= subset_bands]
    if by_sets:
        parts.append(agreeing_counts(groups, m, by_sets))
    listed = [b for b in bs if b > subset_bands]
    if listed:
        apart = compared_counts(groups, m, listed)
        same = groups.where("n > 1").select(F.explode(F.lit(listed)).alias("b"), pair_count("n").alias("pairs"))
        parts += [apart, same]
    counted = parts[0]
    for part in parts[1:]:
        counted = counted.unionByName(part)
    counted = counted.groupBy("b").agg(F.sum("pairs").cast("long").alias("candidates"))
    every = signatures.sparkSession.createDataFrame([(b,) for b in bs], "b int")
    return every.join(counted, "b", "left").select("b", F.coalesce("candidates", F.lit(0)).alias("candidates"))


def band_sets(m: int, bs: Iterable[int]) -> list[tuple[int, int, list[int]]]:
    """Every non-empty set of bands of every count: ``(b, sign, masks)``.

    ``masks`` holds the set's bits, one LONG per signature word; ``sign`` is +1 for sets
    of odd size and -1 for even ones.
    """
    n_words = 1 if m <= WORD_BITS else -(-m // WORD_BITS)
    found = []
    for b in bs:
        r = band_width(m, b)
        for chosen in range(1, 1 << b):
            bits = sum(((1 << r) - 1) << (i * r) for i in range(b) if chosen >> i & 1)
            words = [(bits >> (w * WORD_BITS)) & ((1 << WORD_BITS) - 1) for w in range(n_words)]
            words = [w - (1 << WORD_BITS) if w >= 1 << (WORD_BITS - 1) else w for w in words]
            found.append((b, 1 if chosen.bit_count() % 2 else -1, words))
    return found


def agreeing_counts(groups: DataFrame, m: int, bs: Iterable[int]) -> DataFrame:
    """Document pairs sharing at least one band, ``b, pairs``, by inclusion-exclusion.

    The pairs that agree in some band are the sum, over every non-empty set S of bands, of
    (-1)^(|S| + 1) times the pairs that agree in all bands of S. Each of those is a count:
    documents whose signatures are equal under the mask of S form a group of c, and
    c (c - 1) / 2 pairs. So each distinct signature gives one row per set, and one hash
    aggregation over tasks of about ``TASK_SETS`` rows counts them all; no pair is ever formed, and
    a hot band value costs one counter, not the square of its holders. Equal signatures
    agree everywhere, so their pairs come in through the weights ``n``.
    """
    sets = band_sets(m, bs)
    tasks = max(groups.sparkSession.sparkContext.defaultParallelism, groups.count() * len(sets) // TASK_SETS)
    if m <= WORD_BITS:
        masks, masked = F.array(*[F.lit(masks[0]).cast("long") for _, _, masks in sets]), "sig & mask"
    else:
        masks = F.array(*[F.array(*[F.lit(w).cast("long") for w in masks]) for _, _, masks in sets])
        masked = "zip_with(sig, mask, (w, k) -> w & k)"
    rows = groups.repartition(tasks).select("sig", "n", F.posexplode(masks).alias("set_id", "mask"))
    rows = rows.select("set_id", F.expr(masked).alias("key"), "n").repartition(tasks, "set_id", "key")
    agreeing = rows.groupBy("set_id", "key").agg(F.sum("n").alias("c"))
    of_set = {name: F.array(*[F.lit(row[at]) for row in sets]) for at, name in ((0, "b"), (1, "sign"))}
    terms = agreeing.where("c > 1").select(
        F.element_at(of_set["b"], F.col("set_id") + 1).alias("b"),
        (pair_count("c") * F.element_at(of_set["sign"], F.col("set_id") + 1)).cast("decimal(38,0)").alias("pairs"),
    )
    return terms.groupBy("b").agg(F.sum("pairs").cast("decimal(38,0)").alias("pairs"))


def pair_count(one: str, other: str | None = None) -> Column:
    """Pairs between two groups of the given sizes, or inside one group, as a whole number of 38 digits."""
    size = F.col(one).cast("decimal(19,0)")
    if other is not None:
        return (size * F.col(other).cast("decimal(19,0)")).cast("decimal(38,0)")
    return F.floor(size * (F.col(one) - 1).cast("decimal(19,0)") / 2).cast("decimal(38,0)")


def signature_groups(signatures: DataFrame) -> DataFrame:
    """Distinct signatures with their number of documents, as a written table."""
    return durable(signatures.groupBy("sig").agg(F.count(F.lit(1)).alias("n")), "groups")


def signature_pairs(
    groups: DataFrame, m: int, bs: Iterable[int], max_h: int | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Every two distinct signatures that share a band, once: ``s1, s2, h, bs``.

    ``bs`` lists the band counts under which they share one.

    Buckets above ``block_rows`` signatures are cut into blocks, see :func:`block_pairs`.
    The largest are first keyed by further bits where the threshold leaves room: two
    signatures that differ in at most k bits agree in one of any k + 1 pieces of the
    bits outside the band. Both are exact.
    """
    kind = "bigint" if m <= WORD_BITS else "array<bigint>"
    blocks, keys, tasks, how = banded_blocks(groups.select("sig"), m, bs, max_h, ["sig"], block_rows)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for left, right, one, two, h, shared in met_pairs(batches, keys, how):
            ends = []
            for sigs in (left["sig"][one].view(np.int64), right["sig"][two].view(np.int64)):
                offsets = np.arange(len(sigs) + 1, dtype=np.int32) * sigs.shape[1]
                ends.append(pa.array(sigs[:, 0]) if m <= WORD_BITS else pa.ListArray.from_arrays(offsets, sigs.ravel()))
            yield pa.RecordBatch.from_arrays([*ends, pa.array(h, pa.int32()), shared_lists(shared, how.bs)], ["s1", "s2", "h", "bs"])

    return met(blocks, keys, tasks, listed, f"s1 {kind}, s2 {kind}, h int, bs array<int>")


def banded_blocks(
    rows: DataFrame,
    m: int,
    bs: Iterable[int],
    max_h: int | None,
    spread: list[str],
    block_rows: int = BLOCK_ROWS,
    row_bytes: int = 64,
) -> tuple[DataFrame, list[str], int, Meeting]:
    """``rows`` with a ``sig``, in the blocks in which all that share a band meet, the keys of the blocks, the tasks to
    deal them over, and how they meet. ``spread`` are the columns by which large buckets are cut."""
    bs = list(bs)
    # Without a differing bit allowed, the whole signature is the only band.
    paired = [1] if max_h == 0 else generating_counts(m, bs)
    rows, keys = band_keys(rows, m, paired), BUCKET
    hot, found, largest = hot_keys(rows, keys, block_rows, "hot-buckets")
    if found:
        rows = rows.join(hot, keys, "left")
    pieces = {b: _piece_width(m, b, max_h) for b in paired} if largest > REFINE_BLOCKS else {}
    if any(pieces.values()):
        rows, keys = _with_pieces(rows, pieces, max_h), BUCKET + PIECE_KEYS
        hot, found, _ = hot_keys(rows.where("piece >= 0"), keys, block_rows, "hot-pieces")
        rows = rows.join(hot.withColumnRenamed("g", "g_piece"), keys, "left").withColumn(
            "g", F.when(F.col("piece") >= 0, F.col("g_piece")).otherwise(F.col("g"))
        ).drop("g_piece")
    blocks = block_pairs(rows, keys, spread)
    tasks = task_count(blocks, [*keys, "i", "j"], row_bytes)
    return blocks, keys, tasks, Meeting(m, bs, paired, max_h, pieces)


def compared_counts(groups: DataFrame, m: int, bs: Iterable[int]) -> DataFrame:
    """Document pairs of different signatures that share a band, ``b, pairs``: each block of a bucket gives its counts."""
    blocks, keys, tasks, how = banded_blocks(groups.select("sig", "n"), m, bs, None, ["sig"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for left, right, one, two, _, shared in met_pairs(batches, keys, how):
            both = left["n"][one] * right["n"][two]
            pairs = [int(both[met_in].sum()) for met_in in shared]
            yield pa.RecordBatch.from_arrays([pa.array(how.bs, pa.int32()), pa.array(pairs, pa.int64())], ["b", "pairs"])

    found = met(blocks, keys, tasks, counted, "b int, pairs long")
    return found.select("b", F.col("pairs").cast("decimal(38,0)").alias("pairs"))


def _piece_width(m: int, b: int, max_h: int | None) -> int:
    """Bits in each of the ``max_h + 1`` pieces outside a band; 0 where keying by them gains nothing."""
    if max_h is None or m > WORD_BITS:
        return 0
    width = (m - band_width(m, b)) // (max_h + 1)
    return width if 1 << width >= 8 * (max_h + 1) else 0


def _with_pieces(bands: DataFrame, pieces: dict[int, int], max_h: int) -> DataFrame:
    keyed = "array(named_struct('piece', -1, 'piece_val', 0L))"
    for b, width in pieces.items():
        if width:
            split = piece_array("sig", band_width(WORD_BITS, b), width, max_h + 1)
            keyed = f"if(b = {b} and g > {REFINE_BLOCKS}, {split}, {keyed})"
    return bands.select(*bands.columns, F.inline(F.expr(keyed)))


def same_signature(groups: DataFrame, bs: Iterable[int]) -> DataFrame:
    """Signatures of two or more documents, paired with themselves."""
    sig = F.col("sig")
    return groups.where(F.col("n") > 1).select(
        sig.alias("s1"), sig.alias("s2"), F.lit(0).alias("h"), F.lit(list(bs)).alias("bs")
    )


def document_pairs(
    signatures: DataFrame, m: int, bs: Iterable[int], max_h: int | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """All document pairs sharing a band, once: ``d1, d2, h, bs``, and ``cos`` if the signatures come with ``own_vec``.

    Documents meet in blocks of bounded size that hold all a pair needs, so a pair leaves its
    task finished: no pair is joined, shuffled or written. Copies meet like other documents,
    as each of their pairs is a row of the result.
    """
    scored = "own_vec" in signatures.columns
    columns = ["doc_id", "sig", *(["own_vec"] if scored else [])]
    members = durable(signatures.select(*columns).where(F.col("sig").isNotNull()), "signatures")
    row_bytes = 64
    if scored:
        dim = members.agg(F.max(F.size("own_vec"))).first()[0] or 0
        block_rows = max(1, min(block_rows, BLOCK_BYTES // (8 * dim or 1)))
        row_bytes += 4 * dim
    blocks, keys, tasks, how = banded_blocks(members, m, bs, max_h, ["sig", "doc_id"], block_rows, row_bytes)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for left, right, one, two, h, shared in met_pairs(batches, keys, how):
            d1, d2, no_1, no_2 = left["doc_id"][one], right["doc_id"][two], left["no_id"][one], right["no_id"][two]
            # Rows of one document do not pair as copies. The id of a pair with a nameless one is the other's, twice.
            keep = (h > 0) | ((d1 != d2) & ~no_1 & ~no_2)
            d1, d2, nameless = np.where(no_1, d2, d1), np.where(no_2, d1, d2), no_1 & no_2
            found = [
                pa.array(np.minimum(d1, d2)[keep], mask=nameless[keep]),
                pa.array(np.maximum(d1, d2)[keep], mask=nameless[keep]),
                pa.array(h[keep], pa.int32()),
                shared_lists([with_b[keep] for with_b in shared], how.bs),
            ]
            if scored:
                found.append(_cosines(left["own_vec"], right["own_vec"], one[keep], two[keep], no_1[keep], no_2[keep]))
            yield pa.RecordBatch.from_arrays(found, ["d1", "d2", "h", "bs", "cos"][: len(found)])

    schema = "d1 long, d2 long, h int, bs array<int>" + (", cos double" if scored else "")
    return met(blocks, keys, tasks, listed, schema)


def _cosines(left: np.ndarray, right: np.ndarray, one: np.ndarray, two: np.ndarray, no_1: np.ndarray, no_2: np.ndarray) -> pa.Array:
    """Cosines of pairs of rows in double precision, null with a zero vector; of a nameless row's pair, the other's with itself."""
    if not len(one):
        return pa.array([], pa.float64())
    x, y = ((side.astype(np.float64) ** 2).sum(axis=1)[at] for side, at in ((left, one), (right, two)))
    product = tile_dots(left, right, one, two)
    x, y, product = np.where(no_1, y, x), np.where(no_2, x, y), np.where(no_1, y, np.where(no_2, x, product))
    lengths = np.sqrt(x * y)
    with np.errstate(divide="ignore", invalid="ignore"):
        cos = np.where(lengths > 0, product / lengths, np.nan)
    return pa.array(cos, mask=np.isnan(cos))


def expand_pairs(
    pairs: DataFrame, groups: DataFrame, signatures: DataFrame, member_rows: int = MEMBER_ROWS
) -> DataFrame:
    """Document pairs of signature pairs: ``d1, d2, h, bs``.

    The documents of a signature held by many are cut into salted parts, so no join key
    has more than about ``member_rows`` documents.
    """
    hot, found = hot_signatures(groups, member_rows)
    members = signatures.select("doc_id", "sig")
    if found:
        members = members.join(hot, "sig", "left")
        members = members.select(
            "doc_id", "sig", F.pmod(F.xxhash64("doc_id"), F.coalesce("g", F.lit(1))).cast("int").alias("part")
        )
    else:
        members = members.withColumn("part", F.lit(0))
    for side, doc in (("s1", "d_left"), ("s2", "d_right")):
        if found:
            pairs = pairs.join(hot.withColumnRenamed("sig", side), side, "left")
            pairs = pairs.withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("g", F.lit(1)) - 1))).drop("g")
        else:
            pairs = pairs.withColumn("part", F.lit(0))
        pairs = pairs.join(members.withColumnsRenamed({"sig": side, "doc_id": doc}), [side, "part"]).drop("part")
    left, right = F.col("d_left"), F.col("d_right")
    return pairs.where((F.col("s1") != F.col("s2")) | (left < right)).select(
        F.least(left, right).alias("d1"), F.greatest(left, right).alias("d2"), "h", "bs"
    )


def hot_signatures(groups: DataFrame, member_rows: int) -> tuple[DataFrame, int]:
    """Signatures of more than ``member_rows`` documents with the parts ``g`` each needs, and their count."""
    hot = groups.where(F.col("n") > member_rows)
    found = hot.count()
    return broadcast_if_small(hot.select("sig", F.ceil(F.col("n") / member_rows).cast("int").alias("g")), found), found


def with_own_vectors(signatures: DataFrame, vectors: DataFrame) -> DataFrame:
    """``doc_id, sig, own_vec`` of rows with a signature (and ``vec``), for pairs to be scored where they meet.

    A repeated id gives a row for each of its vectors, as a join of pairs with ``vectors`` would; a missing vector is NaNs.
    """
    signed = signatures.where(F.col("sig").isNotNull()).select("doc_id", "sig", F.size("vec").alias("dim"))
    missing = F.array_repeat(F.lit(float("nan")).cast("float"), F.col("dim"))
    rows = signed.join(vectors.select("doc_id", "vec"), "doc_id", "left")
    return rows.select("doc_id", "sig", F.coalesce("vec", missing).alias("own_vec"))


def with_cosine(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Add the exact cosine ``cos`` of both documents' vectors.

    Pairs that were scored where they met (see :func:`with_own_vectors`) have it; only nameless ones go. For others, two
    joins on the document id, after the Hamming filter; the optimiser picks broadcast or sort-merge by size.
    """
    if "cos" in pairs.columns:
        return pairs.where(F.col("d1").isNotNull())
    left = vectors.select(F.col("doc_id").alias("d1"), F.col("vec").alias("_v1"))
    right = vectors.select(F.col("doc_id").alias("d2"), F.col("vec").alias("_v2"))
    kept = [F.col(c) for c in pairs.columns]
    return pairs.join(left, "d1").join(right, "d2").select(*kept, cosine(F.col("_v1"), F.col("_v2")).alias("cos"))

