"""Passages that repeat across documents, also with edits: shared seeds, collinear chains, alignment.

Seeds are runs of eight words, those with the smallest hash among twelve in a row, so any nineteen equal words
share one. Every occurrence of a seed is matched with the first one in the table: a row per
occurrence, never a row per pair. What this leaves uncovered is met again by whole windows of ``MIN_WORDS`` words,
each with its first occurrence, which then holds a passage whole (``window_matches``). Matches of two documents are chained in order through a Fenwick tree,
and chains are aligned word by word and extended beyond their outer seeds.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bandwise.durable import durable
from bandwise.llm.common import slices
from bandwise.llm.suffix_dedup import running

SEED_WORDS = 8
AMONG = 12
GAP_COST = 0.25
MAX_GAP = 32
EXTEND = 128
DROP = 6
MIN_WORDS = 50
SIMILARITY = 0.8
ASKED = 256
LOT_WORDS = 1 << 20
PAIR = ["doc", "key", "src", "src_key"]


def word_hashes(text: str | None) -> np.ndarray:
    """32-bit hashes of the words of a text, ASCII letters lower-cased, apart at ASCII white space."""
    words = (text or "").encode().lower().split()
    return np.fromiter(map(crc32, words), np.uint32, len(words))


def seeds_of(words: np.ndarray, sizes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the seeds of a text: of each ``AMONG`` runs of words in a row the smallest.

    With ``sizes``, the words are those of as many texts, one after another.
    """
    if len(words) < SEED_WORDS + AMONG - 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(SEED_WORDS.bit_length() - 1):
        step = 1 << k
        h = h[: len(h) - step] * np.uint64(0xD6E8FEB86659FD93 + 2 * k) + h[step:]
        h ^= h >> np.uint64(29)
    least = running(h, AMONG, np.minimum)
    if sizes is not None:
        ends = np.repeat(np.cumsum(sizes), sizes)[: len(least)]
        least[np.arange(len(least)) + (SEED_WORDS + AMONG - 1) > ends] = 0  # reaches into the next text
    edge = np.zeros(AMONG - 1, np.uint64)
    most = running(np.concatenate([edge, least, edge]), AMONG, np.maximum)
    places = np.nonzero(most == h)[0]
    return places, h[places]


def seeds(docs: DataFrame) -> DataFrame:
    """``seed, doc, key, pos`` of every document (``doc, key, text``)."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            each = [word_hashes(t) for t in batch.column(2).to_pylist()]
            sizes = np.array([len(w) for w in each], np.int64)
            places, h = seeds_of(np.concatenate(each), sizes)
            ends = np.cumsum(sizes)
            of = np.searchsorted(ends, places, "right")
            row = pa.array(of)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h.view(np.int64)),
                    batch.column(0).take(row),
                    batch.column(1).take(row),
                    pa.array((places - (ends - sizes)[of]).astype(np.int32)),
                ],
                ["seed", "doc", "key", "pos"],
            )

    return docs.select("doc", "key", "text").mapInArrow(found, "seed long, doc long, key int, pos int")


def windows_of(words: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the runs of ``MIN_WORDS`` words in a text of which all seeds are ``wanted`` hashes."""
    if len(words) < MIN_WORDS:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    places, h = seeds_of(words)
    bad = places[~np.isin(h, wanted)]
    starts = np.arange(len(words) - MIN_WORDS + 1)
    inside = lambda at: np.searchsorted(at, starts + MIN_WORDS - SEED_WORDS, "right") - np.searchsorted(at, starts)
    starts = starts[(inside(places) > 0) & (inside(bad) == 0)]
    mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    factor = np.uint64(0xD6E8FEB86659FD93)
    total, done, run, width = np.zeros(len(starts), np.uint64), 0, mixed, 1
    while True:  # runs of 1, 2, 4 ... words, by doubling; those that add up to the window follow each other in it
        if MIN_WORDS & width:
            total = total * factor + run[starts + done]
            total ^= total >> np.uint64(31)
            done += width
        if done == MIN_WORDS:
            break
        run = run[: len(run) - width] * (factor + np.uint64(2 * width)) + run[width:]
        run ^= run >> np.uint64(29)
        width *= 2
    return starts, total


def outside(rows: DataFrame, passages: DataFrame, width: int) -> DataFrame:
    """The ``rows`` (``doc, key, pos`` and more) whose ``width`` words do not lie whole in one passage of their document."""
    spans = passages.select("doc", "key", F.col("start").cast("int").alias("pos"), F.col("end").alias("reach"))
    both = rows.withColumn("reach", F.lit(None).cast("long")).unionByName(spans, allowMissingColumns=True)
    # The passage that reaches furthest, of those that start here or before.
    furthest = F.max("reach").over(Window.partitionBy("doc", "key").orderBy("pos"))
    bare = both.withColumn("furthest", furthest).where(F.col("reach").isNull())
    return bare.where(F.col("furthest").isNull() | (F.col("furthest") < F.col("pos") + width)).select(*rows.columns)


def window_matches(keyed: DataFrame, all_shared: DataFrame, passages: DataFrame) -> DataFrame:
    """Matches, as of seeds, of the windows that may stand outside all ``passages``, each with its first occurrence.

    Every seed inside a window that repeats is in ``all_shared``. Windows whose seeds all lie in passages need no other
    source; the seeds that lie outside one somewhere tell where to look, in all documents.
    """
    later = all_shared.where(F.struct("doc", "key") != F.struct("first.doc", "first.key"))
    bare = durable(outside(later.select("seed", "doc", "key", "pos"), passages, SEED_WORDS).select("seed").distinct(), "bare-seeds")
    # All shared seeds of the documents that hold one of these: a window may reach into a passage.
    holders = all_shared.join(bare, "seed", "left_semi").select("doc", "key").distinct()
    asked = all_shared.join(holders, ["doc", "key"]).groupBy("doc", "key").agg(F.collect_set("seed").alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            each = []
            for text, wanted in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                each.append(windows_of(word_hashes(text), np.array(wanted, np.int64).view(np.uint64)))
            row = pa.array(np.repeat(np.arange(len(each)), [len(p) for p, _ in each]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([h for _, h in each]).view(np.int64)),
                    batch.column(0).take(row),
                    batch.column(1).take(row),
                    pa.array(np.concatenate([p for p, _ in each]).astype(np.int32)),
                ],
                ["window", "doc", "key", "pos"],
            )

    windows = keyed.dropDuplicates(["doc", "key"]).join(asked, ["doc", "key"]).select("doc", "key", "text", "wanted")
    windows = durable(windows.mapInArrow(cut, "window long, doc long, key int, pos int"), "windows")
    firsts = windows.groupBy("window").agg(F.min(F.struct("doc", "key", "pos")).alias("first"), F.count("*").alias("n"))
    matches = windows.join(firsts.where("n > 1"), "window").where(F.struct("doc", "key") != F.struct("first.doc", "first.key"))
    return outside(matches.select("doc", "key", "pos", "first"), passages, MIN_WORDS).select(
        "doc", "key", F.col("first.doc").alias("src"), F.col("first.key").alias("src_key"), "pos", F.col("first.pos").alias("src_pos")
    )


def segments(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int]]:
    """First and last match of each run on one diagonal, as ``x, y, matches' span``; gaps of over ``MAX_GAP`` words end a run."""
    order = np.lexsort((x, x - y))
    x, y = x[order], y[order]
    fresh = np.ones(len(x), bool)
    fresh[1:] = ((x - y)[1:] != (x - y)[:-1]) | (np.diff(x) > MAX_GAP)
    first = np.nonzero(fresh)[0]
    last = np.append(first[1:], len(x)) - 1
    return list(zip(x[first].tolist(), y[first].tolist(), (x[last] - x[first]).tolist()))


def chains(x: np.ndarray, y: np.ndarray, width: int = SEED_WORDS) -> list[list[tuple[int, int, int]]]:
    """Chains of segments that follow each other in both documents.

    The score of a chain is the words of its segments less ``GAP_COST`` for each word between them in either
    document. Segments are taken by place in x; a Fenwick tree over the places in y holds the
    best score of those that end before, with the gap cost still to come added as if to the end of both texts.
    """
    parts = sorted(segments(x, y))
    if len(parts) == 1:
        return [parts]
    ends = sorted({b + n for _, b, n in parts})
    rank = {e: i + 1 for i, e in enumerate(ends)}
    tree: list[tuple[float, int]] = [(-np.inf, -1)] * (len(ends) + 1)
    score, back = [0.0] * len(parts), [-1] * len(parts)
    waiting = sorted(range(len(parts)), key=lambda i: parts[i][0] + parts[i][2])
    done = 0
    starts = np.searchsorted(ends, [b for _, b, _ in parts], side="left").tolist()  # how many ends lie below
    for i, (a, b, n) in enumerate(parts):
        while done < len(parts) and parts[waiting[done]][0] + parts[waiting[done]][2] < a:
            j = waiting[done]
            c, d, m = parts[j]
            entry = (score[j] + GAP_COST * (c + m + d + m), j)
            at = rank[d + m]
            while at <= len(ends):
                if entry > tree[at]:
                    tree[at] = entry
                at += at & -at
            done += 1
        best, at = (-np.inf, -1), starts[i]
        while at:
            best = max(best, tree[at])
            at -= at & -at
        gain = best[0] - GAP_COST * (a + b)
        own = n + width
        score[i], back[i] = (own + gain, best[1]) if gain > 0 else (float(own), -1)
    used = [False] * len(parts)
    out = []
    for i in sorted(range(len(parts)), key=lambda i: -score[i]):
        chain: list[tuple[int, int, int]] = []
        while i >= 0 and not used[i]:
            used[i] = True
            a, b, n = parts[i]
            if chain and max(chain[-1][0] - (a + n), chain[-1][1] - (b + n)) > MAX_GAP + width:
                out.append(chain[::-1])
                chain = []
            chain.append(parts[i])
            i = back[i]
        if chain:
            out.append(chain[::-1])
    return out


def chained(matches: DataFrame, width: int = SEED_WORDS) -> DataFrame:
    """``doc, key, src, src_key, parts`` of every chain; ``parts`` has x, y and span of its segments, flat."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found)) if found else [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*PAIR, "parts"])

        def flush(key: tuple, held: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple]:
            x, y = (np.concatenate(c).astype(np.int64) for c in zip(*held))
            return [(*key, [v for part in chain for v in part]) for chain in chains(x, y, width)]

        key, held = None, []
        for batch in batches:
            found = []
            marks = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            x, y = batch.column(4).to_numpy(), batch.column(5).to_numpy()
            changed = np.any([m[1:] != m[:-1] for m in marks], axis=0)
            cuts = [0, *(np.nonzero(changed)[0] + 1).tolist(), batch.num_rows]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                here = tuple(m[i].item() for m in marks)
                if here != key:
                    if held:
                        found += flush(key, held)
                    key, held = here, []
                held.append((x[i:j], y[i:j]))
            yield made(found)
        if held:
            yield made(flush(key, held))

    rows = matches.repartition(*PAIR).sortWithinPartitions(*PAIR).select(*PAIR, "pos", "src_pos")
    return rows.mapInArrow(linked, "doc long, key int, src long, src_key int, parts array<int>")


def extensions(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray, most: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """How far to go on from places x in a and y in b, by ``step`` and ``most`` words, while words match mostly, and how many
    of them match: a match counts 1, another word -2, and the search ends ``DROP`` below the best."""
    none = np.zeros(len(x), np.int64)
    if not len(x) or most.max() <= 0:
        return none, none
    over = np.arange(most.max())
    inside = over < most[:, None]
    go = np.where(inside, over * step, 0)
    equal = a[np.where(inside, x[:, None] + go, 0)] == b[np.where(inside, y[:, None] + go, 0)]
    total = np.cumsum(np.where(equal, 1, -2), axis=1, dtype=np.int32)
    best = np.maximum.accumulate(np.maximum(total, 0), axis=1)
    ended = np.logical_or.accumulate(~inside | (total < best - DROP), axis=1)
    total[ended] = -1
    end = total.argmax(axis=1)
    top = total[np.arange(len(x)), end].astype(np.int64)
    end = np.where(top > 0, end + 1, 0)
    return end, np.where(top > 0, (top + 2 * end) // 3, 0)


def commons(a: np.ndarray, b: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    """Words in the longest common subsequence of each two short runs; a row of ``gaps`` is x, its end, y, its end."""
    out = np.zeros(len(gaps), np.int64)
    size = (gaps[:, 1] - gaps[:, 0]) * 4096 + gaps[:, 3] - gaps[:, 2]
    order = np.argsort(size, kind="stable")
    for at in range(0, len(order), 1024):  # alike sizes together, so that little of a lot is filled up
        lot = order[at : at + 1024]
        x, x1, y, y1 = gaps[lot].T
        over = np.arange((y1 - y).max())
        inside = over < (y1 - y)[:, None]
        right = b[np.where(inside, y[:, None] + over, 0)]
        row = np.zeros((len(lot), len(over) + 1), np.int32)
        for k in range((x1 - x).max()):
            open_ = x + k < x1
            word = a[np.where(open_, x + k, 0)]
            hit = (right == word[:, None]) & inside & open_[:, None]
            row[:, 1:] = np.maximum.accumulate(np.maximum(row[:, 1:], row[:, :-1] + hit), axis=1)
        out[lot] = row[:, -1]
    return out


def matching(a: np.ndarray, b: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Equal words of two runs side by side; a row of ``runs`` is x, y and the length."""
    out = np.zeros(len(runs), np.int64)
    long = runs[:, 2] > 512
    for i in np.nonzero(long)[0]:
        x, y, n = runs[i]
        out[i] = (a[x : x + n] == b[y : y + n]).sum()
    short = np.nonzero(~long)[0]
    for at in range(0, len(short), 4096):
        lot = short[at : at + 4096]
        x, y, n = runs[lot].T
        first = np.cumsum(n) - n
        over = np.arange(n.sum()) - np.repeat(first, n)
        equal = a[np.repeat(x, n) + over] == b[np.repeat(y, n) + over]
        out[lot] = np.add.reduceat(equal.astype(np.int64), first) if len(lot) else 0
    return out


def aligned(
    a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, found: list[list[int]], width: int = SEED_WORDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end in both and the matching words of chains, extended at both sides.

    The words of chain i are those from ``a_at[i]`` to ``a_at[i + 1]`` in a, and so in b; its parts are places in a and b.
    """
    ends, runs, gaps, run_of, gap_of = [], [], [], [], []
    for i, flat in enumerate(found):
        x, y = flat[0], flat[1]
        for k in range(0, len(flat), 3):
            c, d, n = flat[k : k + 3]
            skip = max(0, x - c, y - d)
            c, d, n = c + skip, d + skip, n + width - skip
            if n <= 0:
                continue
            if c > x and d > y:
                gaps.append((x, c, y, d))
                gap_of.append(i)
            runs.append((c, d, n))
            run_of.append(i)
            x, y = c + n, d + n
        ends.append((flat[0], x, flat[1], y))
    x0, x1, y0, y1 = np.array(ends, np.int64).reshape(-1, 4).T
    matched = np.zeros(len(found), np.int64)
    if runs:
        np.add.at(matched, run_of, matching(a, b, np.array(runs, np.int64)))
    if gaps:
        np.add.at(matched, gap_of, commons(a, b, np.array(gaps, np.int64)))
    more, hit = extensions(a, x1, b, y1, np.minimum(a_at[1:] - x1, b_at[1:] - y1), 1)
    less, hit0 = extensions(a, x0 - 1, b, y0 - 1, np.minimum(x0 - a_at[:-1], y0 - b_at[:-1]), -1)
    return x0 - less, x1 + more, y0 - less, y1 + more, matched + hit + hit0


def word_runs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words of a column of binary values, one after another, and where each value begins, and the end."""
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    words = np.frombuffer(data, np.uint8)[at[0] : at[-1]].view("<u4") if data and at[-1] > at[0] else np.empty(0, "<u4")
    return words, (at - at[0]) // 4


def repeated_passages(docs: DataFrame) -> DataFrame:
    """``doc_id, start, end, source_id, source_start, source_end, matched, similarity`` of every passage that repeats an
    earlier document, by id: places in words, end exclusive.

    A passage has ``MIN_WORDS`` words or more on both sides, and ``similarity``, matching words over
    the mean length, of at least ``SIMILARITY``. Of several earlier documents, the first to hold a seed, or
    else a run of ``MIN_WORDS`` words, is the source, so every seed in an exact repeat of ``MIN_WORDS`` words lies in a passage;
    at its ends fewer than ``SEED_WORDS + AMONG - 1`` words may not.
    Null and empty texts have no passages. Rows that repeat an id and a text are one document; other rows that share
    an id are apart. Null ids take no part.
    """
    keyed = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    keyed = keyed.select(F.col("doc_id").cast("long").alias("doc"), F.hash("text").alias("key"), "text")
    found = durable(seeds(keyed), "seeds")
    # Most seeds stand in one place: counted by hash, they go before any others are sorted and joined.
    often = found.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1").select("seed")
    often = durable(found.join(often, "seed", "left_semi"), "frequent-seeds")
    whole = F.struct("doc", "key")
    firsts = often.groupBy("seed").agg(
        F.min(F.struct("doc", "key", "pos")).alias("first"), F.max(whole).alias("last")
    )
    firsts = firsts.where(F.struct("first.doc", "first.key") < F.col("last")).select("seed", "first")
    shared = durable(often.join(firsts, "seed"), "shared-seeds")
    matches = shared.where(whole != F.struct("first.doc", "first.key"))
    matches = matches.select(
        "doc", "key", F.col("first.doc").alias("src"), F.col("first.key").alias("src_key"), "pos", F.col("first.pos").alias("src_pos")
    )
    passages = durable(aligned_passages(keyed, matches, SEED_WORDS), "passages")
    again = window_matches(keyed, shared, passages)
    names = [c for c in passages.columns if c not in ("key", "doc")]
    out = passages.unionByName(aligned_passages(keyed, again, MIN_WORDS)).select(F.col("doc").alias("doc_id"), *names)
    return out.dropDuplicates(["doc_id", "start", "end", "source_id", "source_start", "source_end"])


def aligned_passages(keyed: DataFrame, matches: DataFrame, width: int) -> DataFrame:
    """``doc, key`` and the other columns of ``repeated_passages`` from matches of runs of ``width`` equal words."""
    links = durable(chained(matches, width).withColumn("id", F.monotonically_increasing_id()), "chains")

    ends = F.slice("parts", -3, 3)
    sides = F.array(
        F.struct("doc", "key", F.lit(0).alias("side"), F.col("parts")[0].alias("low"), (ends[0] + ends[2]).alias("high")),
        F.struct(
            F.col("src").alias("doc"),
            F.col("src_key").alias("key"),
            F.lit(1).alias("side"),
            F.col("parts")[1].alias("low"),
            (ends[1] + ends[2]).alias("high"),
        ),
    )
    asked = links.select("id", F.explode(sides).alias("s")).select("s.doc", "s.key", "id", "s.side", "s.low", "s.high")
    # A document that many others repeat is asked for in lots, each with a bounded list.
    lots = asked.groupBy("doc", "key").agg(F.ceil(F.count("*") / ASKED).alias("lots"))
    asked = asked.join(lots, ["doc", "key"]).withColumn("lot", F.pmod(F.xxhash64("id", "side"), "lots"))
    asked = asked.groupBy("doc", "key", "lot").agg(F.collect_list(F.struct("id", "side", "low", "high")).alias("asked"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            each = [word_hashes(t) for t in batch.column(0).to_pylist()]
            words = np.concatenate(each)
            sizes = np.array([len(w) for w in each], np.int64)
            count = pc.list_value_length(batch.column(1)).to_numpy()
            size, first = np.repeat(sizes, count), np.repeat(np.cumsum(sizes) - sizes, count)
            ids, sides, low, high = (f.to_numpy() for f in batch.column(1).flatten().flatten())
            low = np.maximum(0, low - EXTEND)
            length = np.maximum(np.minimum(high.astype(np.int64) + (width + EXTEND), size) - low, 0)
            lots = np.cumsum(length) // LOT_WORDS
            for at in np.split(np.arange(len(ids)), np.nonzero(np.diff(lots))[0] + 1):
                n = length[at]
                ends = np.concatenate([[0], np.cumsum(n)])
                places = np.arange(ends[-1]) + np.repeat(first[at] + low[at] - ends[:-1], n)
                buffers = [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(words[places].astype("<u4"))]
                runs = pa.Array.from_buffers(pa.binary(), len(at), buffers)
                columns = [pa.array(ids[at]), pa.array(sides[at]), pa.array(low[at].astype(np.int32)), runs]
                yield pa.RecordBatch.from_arrays(columns, ["id", "side", "low", "words"])

    cuts = keyed.join(asked, ["doc", "key"]).select("text", "asked")
    cuts = cuts.mapInArrow(cut, "id long, side int, low int, words binary")
    # Rows that repeat an id and a text give a cut each.
    two = cuts.groupBy("id").agg(
        *[F.max(F.when(F.col("side") == s, F.struct("low", "words"))).alias(f"side{s}") for s in (0, 1)]
    )
    pairs = links.join(two, "id").select(
        "doc", "key", "src", "parts", *[F.col(f"side{s}.{c}").alias(f"{c}{s}") for s in (0, 1) for c in ("low", "words")]
    )

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            if not batch.num_rows:
                continue
            (a, a_at), (b, b_at) = word_runs(batch.column("words0")), word_runs(batch.column("words1"))
            low0, low1 = (batch.column(c).to_numpy().astype(np.int64) for c in ("low0", "low1"))
            found = batch.column("parts").to_pylist()
            for i, (dx, dy) in enumerate(zip((a_at[:-1] - low0).tolist(), (b_at[:-1] - low1).tolist())):
                found[i] = [v + (dx, dy, 0)[k % 3] for k, v in enumerate(found[i])]
            x0, x1, y0, y1, matched = aligned(a, a_at, b, b_at, found, width)
            likeness = 2 * matched / (x1 - x0 + y1 - y0)
            kept = np.nonzero((np.minimum(x1 - x0, y1 - y0) >= MIN_WORDS) & (likeness >= SIMILARITY))[0]
            to_x, to_y = low0 - a_at[:-1], low1 - b_at[:-1]
            ids = [batch.column(c).take(pa.array(kept)) for c in ("doc", "key", "src")]
            numbers = [x0 + to_x, x1 + to_x, y0 + to_y, y1 + to_y, matched, likeness]
            start, end, src_start, src_end, matched, likeness = (pa.array(c[kept]) for c in numbers)
            yield pa.RecordBatch.from_arrays([*ids[:2], start, end, ids[2], src_start, src_end, matched, likeness], names)

    names = ["doc", "key", "start", "end", "source_id", "source_start", "source_end", "matched", "similarity"]
    kind_names = {"similarity": "double", "key": "int"}
    schema = ", ".join(f"{n} {kind_names.get(n, 'long')}" for n in names)
    return pairs.mapInArrow(align, schema)
