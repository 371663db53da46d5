"""Bytes covered by 200-byte strings that start more than once, from a sparse suffix array.

Of every 200-byte window, the places with the smallest hash of 64 bytes are anchors. Equal windows have equal
anchors at equal offsets, so only suffixes that start at anchors need sorting: about one byte in 70.
Of these, only those whose first 64 bytes occur again. Anchors whose whole surroundings, all that a window around
them can hold, occur again (by their digest) are decided by that: all their windows repeat, and one of them stands for all. Only
the others, and one of each such class, go on with their bytes (``decided``). Spark samples splitters and
range-partitions the suffixes by their leading bytes; a bucket sorts its suffixes, and the reversed texts
before them, by multikey quicksort over 8-byte characters. Classes of suffixes that agree in r bytes and of
reversed prefixes that agree in 200 - r bytes then tell which windows occur again. Splitters never part equal leading bytes,
so nothing that matches lies across a boundary.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.durable import durable
from bandwise.llm.common import slices

WINDOW = 200
SEED = 64
REACH = WINDOW - SEED  # how far before an anchor a window may start
HOT_ROWS = 50_000
BATCH_ROWS = 16_384
CHUNK_BYTES = 1 << 20
KEY = ["k1", "k2"]


def running(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` of each ``width`` consecutive values, by doubling."""
    done, span = values, 1
    while span < width:
        step = min(span, width - span)
        done = best(done[: len(done) - step], done[step:])
        span += step
    return done


def anchor_places(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of texts that lie one after another; ``starts`` has their beginnings and the end."""
    none = np.empty(0, np.int64), np.empty(0, np.uint64)
    if len(data) < WINDOW:
        return none
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(SEED.bit_length() - 1):
        step = 1 << k
        h = h[: len(h) - step] * np.uint64(0xD6E8FEB86659FD93 + 2 * k) + h[step:]
        h ^= h >> np.uint64(29)
    h |= np.uint64(1)  # never zero
    least = running(h, REACH + 1, np.minimum)
    inside = np.zeros(len(least), bool)
    for i, j in zip(starts[:-1], starts[1:]):
        inside[i : max(i, j - WINDOW + 1)] = True
    least[~inside] = 0
    padded = np.concatenate([np.zeros(REACH, np.uint64), least, np.zeros(REACH, np.uint64)])
    most = running(padded, REACH + 1, np.maximum)
    places = np.nonzero(most == h)[0]
    return places, h[places]


def around(text: bytes, pos: int) -> int:
    """Digest of the bytes around an anchor that windows with it can hold, and of how many of them precede it."""
    before = min(pos, REACH)
    return int.from_bytes(blake2b(text[pos - before : pos + WINDOW], digest_size=8, salt=bytes([before])).digest(), "little", signed=True)


def anchors(docs: DataFrame) -> DataFrame:
    """``k1, k2, pos, anchor, around, after`` of every anchor of ``docs`` (``k1, k2, text``): its digest ``around`` and
    how many bytes of a window the text has from it on."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(k1, k2, texts) -> pa.RecordBatch:
            starts = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
            places, h = anchor_places(np.frombuffer(b"".join(texts), np.uint8), starts)
            row = np.searchsorted(starts, places, side="right") - 1
            return batch_of(k1[row], k2[row], places - starts[row], h, [texts[i] for i in row])

        def batch_of(k1, k2, pos, h, texts) -> pa.RecordBatch:
            digests = np.fromiter(map(around, texts, pos.tolist()), np.int64, len(pos))
            after = np.minimum(np.fromiter(map(len, texts), np.int64, len(pos)) - pos, WINDOW)
            columns = [k1, k2, pos.astype(np.int64), h.view(np.int64), digests, after.astype(np.int32)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["k1", "k2", "pos", "anchor", "around", "after"])

        for batch in slices(batches, 256):
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            first, size = 0, 0
            for i, text in enumerate(texts):
                if len(text) > CHUNK_BYTES:  # in overlapping pieces; an anchor of two pieces counts once
                    last = -1
                    for at in range(0, len(text), CHUNK_BYTES):
                        part = np.frombuffer(text[at : at + CHUNK_BYTES + WINDOW - 1], np.uint8)
                        places, h = anchor_places(part, np.array([0, len(part)]))
                        places = places + at
                        new = places > last
                        places, h = places[new], h[new]
                        if len(places):
                            last = places[-1]
                            yield batch_of(np.full(len(places), k1[i]), np.full(len(places), k2[i]), places, h, [text] * len(places))
                    texts[i] = b""
                size += len(texts[i])
                if size >= CHUNK_BYTES or i == len(texts) - 1:
                    yield emit(k1[first : i + 1], k2[first : i + 1], texts[first : i + 1])
                    first, size = i + 1, 0

    return docs.select(*KEY, "text").mapInArrow(found, "k1 long, k2 int, pos long, anchor long, around long, after int")


DECIDED = "k1 long, k2 int, pos long, anchor long, told boolean, start long, end long"


def decided(found: DataFrame) -> DataFrame:
    """Of all ``anchors`` those that occur again: ``start, end`` of the repeated bytes around each one whose digest occurs again;
    and ``pos, anchor`` of each whose bytes are needed, which are, of anchors with several digests, one of each digest.
    ``told`` marks those of them that have their ``start, end`` already and are there for the others."""
    names = [f.split()[0] for f in DECIDED.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def runs(r: tuple) -> Iterator[tuple]:
            _, _, k1, k2, pos, after = r
            before = min(pos, REACH)
            if before + after >= WINDOW:
                yield k1, k2, None, None, None, pos - before, pos + after

        def asked(r: tuple, told: bool) -> tuple:
            return r[2], r[3], r[4], r[0], told, None, None

        def told() -> Iterator[tuple]:
            rows = (r for batch in batches for part in slices([batch], 4096) for r in zip(*(c.to_pylist() for c in part.columns)))
            for _, same_anchor in groupby(rows, itemgetter(0)):
                leading = None  # the first digest's, needed once there is a second digest
                for number, (_, same) in enumerate(groupby(same_anchor, itemgetter(1))):
                    one, two = next(same), next(same, None)
                    if number == 0:
                        leading = asked(one, two is not None)
                    else:
                        if number == 1:
                            yield leading
                        yield asked(one, two is not None)
                    if two is not None:
                        yield from runs(one)
                        yield from runs(two)
                        for r in same:
                            yield from runs(r)

        held: list[tuple] = []
        for row in told():
            held.append(row)
            if len(held) == BATCH_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
                held = []
        columns = list(zip(*held)) if held else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    rows = found.repartition("anchor").sortWithinPartitions("anchor", "around")
    return rows.select("anchor", "around", "k1", "k2", "pos", "after").mapInArrow(read, DECIDED)


def contexts(asked: DataFrame) -> DataFrame:
    """``anchor, k1, k2, pos, told, before, after``: up to ``REACH`` bytes before each asked place, reversed, and ``WINDOW`` from it on."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            rows = batch.column(3)
            at, pos, anchor, told, before, after = [], [], [], [], [], []
            for i, text in enumerate(batch.column(2).cast(pa.binary()).to_pylist()):
                for hit in rows[i].as_py():
                    p = hit["pos"]
                    at.append(i)
                    pos.append(p)
                    anchor.append(hit["anchor"])
                    told.append(hit["told"])
                    before.append(text[max(0, p - REACH) : p][::-1])
                    after.append(text[p : p + WINDOW])
                if len(at) >= BATCH_ROWS:
                    yield made(batch, at, pos, anchor, told, before, after)
                    at, pos, anchor, told, before, after = [], [], [], [], [], []
            yield made(batch, at, pos, anchor, told, before, after)

    def made(batch, at, pos, anchor, told, before, after) -> pa.RecordBatch:
        index = pa.array(at, pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(anchor, pa.int64()),
                batch.column(0).take(index),
                batch.column(1).take(index),
                pa.array(pos, pa.int64()),
                pa.array(told, pa.bool_()),
                pa.array(before, pa.binary()),
                pa.array(after, pa.binary()),
            ],
            ["anchor", "k1", "k2", "pos", "told", "before", "after"],
        )

    schema = "anchor long, k1 long, k2 int, pos long, told boolean, before binary, after binary"
    # With doc_id the texts are shuffled as for the last step, so Spark shuffles them once for both.
    return asked.select(*KEY, "text", "hits", "doc_id").mapInArrow(cut, schema)


def characters(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings of at most ``width`` as rows of big-endian 8-byte numbers, padded by zeros, and their lengths."""
    lengths = np.array([len(x) for x in column.to_pylist()], np.int64)
    table = np.zeros((len(lengths), -(-width // 8) * 8), np.uint8)
    flat = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    table[np.arange(table.shape[1])[None, :] < lengths[:, None]] = flat
    return table.view(">u8").astype(np.uint64), lengths


def multikey_order(group: np.ndarray, chars: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of strings inside groups, and the bytes each shares with the one before it (-1 at a new group).

    Multikey quicksort, level by level: each level parts the ranges of strings equal so far by their
    next 8-byte character, and only ranges of two or more go on.
    """
    order = np.argsort(group, kind="stable")
    shared = np.full(len(order), -1, np.int64)
    fresh = np.ones(len(order), bool)  # a range starts here
    fresh[1:] = group[order][1:] != group[order][:-1]
    for depth in range(chars.shape[1]):
        ranges = np.cumsum(fresh)
        alone = fresh & np.append(fresh[1:], True)
        at = np.nonzero(~alone)[0]
        if not len(at):
            break
        rows = order[at]
        rows = rows[np.lexsort((chars[rows, depth], ranges[at]))]
        order[at] = rows
        here = chars[rows, depth]
        differs = np.zeros(len(at), bool)
        differs[1:] = (here[1:] != here[:-1]) & (ranges[at][1:] == ranges[at][:-1])
        spot = np.nonzero(differs)[0]
        gap = here[spot] ^ here[spot - 1]
        same = np.zeros(len(spot), np.int64)
        for byte in range(7, 0, -1):
            same += (gap >> np.uint64(8 * byte)) == 0
        shared[at[spot]] = 8 * depth + same
        fresh[at[spot]] = True
    equal = ~fresh
    shared[equal] = 8 * chars.shape[1]
    both = np.minimum(lengths[order], np.roll(lengths[order], 1))
    return order, np.where(shared >= 0, np.minimum(shared, both), -1)


def repeated_windows(group: np.ndarray, before: pa.Array, after: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each row the most and the fewest bytes before its anchor from which a window starts that occurs in
    another row of its group; -1 if there is none."""
    n = len(group)
    right, right_len = characters(after, WINDOW)
    left, left_len = characters(before, REACH)
    r_order, r_shared = multikey_order(group, right, right_len)
    l_order, l_shared = multikey_order(group, left, left_len)
    most, least = np.full(n, -1), np.full(n, -1)
    r_class, l_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for a in range(REACH + 1):
        fits = (left_len >= a) & (right_len >= WINDOW - a)
        if not fits.any():
            continue
        r_class[r_order] = np.cumsum(r_shared < WINDOW - a)
        l_class[l_order] = np.cumsum(l_shared < a)
        rows = np.nonzero(fits)[0]
        code = r_class[rows] * (n + 1) + l_class[rows]
        by = np.argsort(code, kind="stable")
        twin = code[by][1:] == code[by][:-1]
        hit = np.zeros(len(rows), bool)
        hit[1:] |= twin
        hit[:-1] |= twin
        again = rows[by[hit]]
        most[again] = a
        least[again] = np.where(least[again] < 0, a, least[again])
    return most, least


def sorted_buckets(rows: DataFrame) -> DataFrame:
    """``k1, k2, start, end`` of the repeated bytes around each anchor not ``told`` yet. Windows around one anchor overlap, so they are one run."""

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            anchor, pos = table.column("anchor").to_numpy(), table.column("pos").to_numpy()
            before, after = (table.column(c).combine_chunks() for c in ("before", "after"))
            most, least = repeated_windows(anchor, before, after)
            kept = (most >= 0) & ~table.column("told").to_numpy()
            index = pa.array(np.nonzero(kept)[0])
            return pa.RecordBatch.from_arrays(
                [
                    table.column("k1").combine_chunks().take(index),
                    table.column("k2").combine_chunks().take(index),
                    pa.array(pos[kept] - most[kept]),
                    pa.array(pos[kept] - least[kept] + WINDOW),
                ],
                ["k1", "k2", "start", "end"],
            )

        held, count = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                held.append(part)
                count += part.num_rows
                if count < BATCH_ROWS:
                    continue
                keys = np.concatenate([x.column(0).to_numpy() for x in held])
                cut = int(np.argmax(keys == keys[-1]))  # the last anchor may go on
                if cut == 0:
                    continue
                rows = pa.Table.from_batches(held)
                yield flush(rows.slice(0, cut).to_batches())
                held = rows.slice(cut).to_batches()
                count -= cut
        if held and count:
            yield flush(held)

    # The first eight bytes lead; the hash of all 64 keeps equal ones together in the order.
    lead = F.substring("after", 1, 8)
    spread = rows.repartitionByRange(lead, "anchor").sortWithinPartitions("anchor")
    return spread.select("anchor", "k1", "k2", "pos", "told", "before", "after").mapInArrow(
        matched, "k1 long, k2 int, start long, end long"
    )


def hot_windows(rows: DataFrame) -> DataFrame:
    """The same for anchors of more than ``HOT_ROWS``: equal surroundings count once, then every window has a key of its own
    and is counted by key, so no anchor needs one task."""
    left, right = F.octet_length("before"), F.octet_length("after")
    # Rows opened by window carry a digest of their surroundings in place of the bytes.
    key = F.unhex(F.md5(F.concat(F.lpad(left.cast("string"), 3, "0").cast("binary"), "before", "after"))).alias("surroundings")
    once = rows.groupBy("anchor", "before", "after").agg(F.count("*").alias("n"))
    low, high = F.greatest(F.lit(0), WINDOW - right), F.least(F.lit(REACH), left)
    places = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    opened = once.select("anchor", "before", "after", key, "n", F.explode(places).alias("a"))
    window = F.concat(F.substring("before", F.lit(1), F.col("a")), F.substring("after", F.lit(1), WINDOW - F.col("a")))
    keyed = opened.select("anchor", "surroundings", "n", "a", F.unhex(F.md5(window)).alias("window"))
    counts = keyed.groupBy("anchor", "a", "window").agg(F.sum("n").alias("times")).where("times > 1").drop("times")
    # Spark sizes these by the compressed table and as if explode made no more rows, and would send them whole.
    again = keyed.join(counts.hint("merge"), ["anchor", "a", "window"])
    again = again.groupBy("anchor", "surroundings").agg(F.max("a").alias("most"), F.min("a").alias("least"))
    open_rows = rows.where(~F.col("told")).select(*KEY, "pos", "anchor", key)
    return open_rows.join(again.hint("merge"), ["anchor", "surroundings"]).select(
        *KEY, (F.col("pos") - F.col("most")).alias("start"), (F.col("pos") - F.col("least") + WINDOW).alias("end")
    )


def without_repeats(docs: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept`` of every document: ``spans`` are the maximal runs of bytes covered by
    a ``WINDOW``-byte string that also starts elsewhere, in this document or another; ``kept`` is the rest.

    Null texts count as empty. Strings never cross documents, and are judged on the input. Null and repeated
    ids keep their rows; rows that repeat an id and a text repeat each other's strings.
    """
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64("doc_id", text).alias("k1"), F.hash(text, "doc_id").alias("k2")
    )
    found = durable(decided(anchors(keyed)), "decided")
    asked = found.where("anchor is not null")
    hot = durable(asked.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > hot_rows).select("anchor"), "hot-anchors")

    def surrounded(which: DataFrame) -> DataFrame:
        hits = which.groupBy(*KEY).agg(F.collect_set(F.struct("pos", "anchor", "told")).alias("hits"))
        return contexts(keyed.join(hits, KEY))

    spans = found.where("start is not null").select(*KEY, "start", "end")
    if hot.count():
        spans = spans.unionByName(sorted_buckets(surrounded(asked.join(hot, "anchor", "left_anti"))))
        spans = spans.unionByName(hot_windows(durable(surrounded(asked.join(hot, "anchor")), "hot")))
    else:
        spans = spans.unionByName(sorted_buckets(surrounded(asked)))
    runs = spans.groupBy(*KEY).agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    joined = keyed.join(runs, KEY, "left").select("doc_id", "text", "runs")

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            sizes, removed, merged, kept = [], [], [], []
            for text, runs in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                whole: list[list[int]] = []
                for run in sorted((r["start"], r["end"]) for r in runs or []):
                    if whole and run[0] <= whole[-1][1]:
                        whole[-1][1] = max(whole[-1][1], run[1])
                    else:
                        whole.append(list(run))
                edges = [0, *(x for run in whole for x in run), len(text)]
                kept.append(b"".join(text[i:j] for i, j in zip(edges[::2], edges[1::2])))
                sizes.append(len(text))
                removed.append(len(text) - len(kept[-1]))
                merged.append([{"start": i, "end": j} for i, j in whole])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(merged, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(kept, pa.binary()),
                ],
                ["doc_id", "n_bytes", "n_removed", "spans", "kept"],
            )

    schema = "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary"
    return joined.mapInArrow(rest, schema)
