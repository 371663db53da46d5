"""Runs in the word sequences of texts: maximal stretches with a short period, and the texts without their repeats.

Method, per text (in one task; a text is never split):

* Words get dense ids; the blocks of 2^t words at every position get exact names by doubling
  (the name at level t + 1 is the pair of names at level t), so equal names mean equal words
  and a sort of names is the suffix array cut to 2^t words.
* Dyadic blocks: a run of smallest period q and length >= 2q holds an aligned block of
  l = 2^t words (l <= q / 2, q < 4 l) that occurs again q words later. For every aligned block,
  the range successor over positions sorted by (name, position) lists the block's occurrences in
  the neighbouring window of 4 l words; each distance is a candidate period.
* Each candidate is extended left and right, exactly, by longest common extensions over the
  names (binary lifting). A maximal stretch found with several periods has as smallest period
  the least of them (Fine and Wilf: its smallest period divides each), so stretches are grouped
  and keep their least period.

Work per text is O(n log^2 n) for n words, memory O(n log n) integers of 8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from bandwise.llm.common import let, slices

#: Fixed value of the contract: the least length of a run.
MIN_LENGTH = 12
#: Words in a row that recur one period later in every run: it has at least max(12, 2 q) - q equal ones, so six.
RECURRING = 6

RUN = "struct<start:bigint,length:bigint,period:bigint>"
ADDED = {"n_words": "bigint", "runs": f"array<{RUN}>", "collapsed": "string"}


def _names(ids: np.ndarray) -> list[np.ndarray]:
    """Names of the blocks of 2^t words at each start, for every t with 2^t <= n."""
    n = len(ids)
    levels = [ids.astype(np.int64)]
    width = 1
    while 2 * width <= n:
        last = levels[-1]
        pair = last[: n - 2 * width + 1] * (n + 1) + last[width : n - width + 1]
        levels.append(np.unique(pair, return_inverse=True)[1].astype(np.int64))
        width *= 2
    return levels


def _extension(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Longest common extension of the words from ``a`` and from ``b``, for arrays of starts."""
    n = len(levels[0])
    done = np.zeros(len(a), dtype=np.int64)
    top = len(levels) - 1
    # The top level may be needed more than once; every lower one once, from high to low.
    while True:
        width = 1 << top
        ok = (a + done + width <= n) & (b + done + width <= n)
        at_a, at_b = np.where(ok, a + done, 0), np.where(ok, b + done, 0)
        ok &= levels[top][np.minimum(at_a, len(levels[top]) - 1)] == levels[top][np.minimum(at_b, len(levels[top]) - 1)]
        if not ok.any():
            break
        done += np.where(ok, width, 0)
    for t in range(top - 1, -1, -1):
        width = 1 << t
        ok = (a + done + width <= n) & (b + done + width <= n)
        at_a, at_b = np.where(ok, a + done, 0), np.where(ok, b + done, 0)
        ok &= levels[t][np.minimum(at_a, len(levels[t]) - 1)] == levels[t][np.minimum(at_b, len(levels[t]) - 1)]
        done += np.where(ok, width, 0)
    return done


def _recurs(ids: np.ndarray) -> bool:
    """Whether ``RECURRING`` words in a row may stand twice, by their hashes: never false if they do."""
    h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    blocks = len(ids) - RECURRING + 1
    total = np.zeros(blocks, np.uint64)
    for k in range(RECURRING):
        total = total * np.uint64(0xD6E8FEB86659FD93) + h[k : k + blocks]
    total.sort()
    return bool((total[1:] == total[:-1]).any())


def runs_of(ids: np.ndarray) -> np.ndarray:
    """Every run of a sequence of word ids as rows ``start, length, period``, by start, then period."""
    n = len(ids)
    if n < MIN_LENGTH or not _recurs(ids):
        return np.zeros((0, 3), dtype=np.int64)
    forward, backward = _names(ids), _names(ids[::-1])
    found_j, found_d = [], []
    for t, names in enumerate(forward):
        width = 1 << t
        if 2 * width > n:
            break
        # Positions sorted by (name, position): a block's occurrences in its window are one range of that order.
        size = len(names)
        keys = np.sort(names * size + np.arange(size))
        blocks = np.arange(0, size, width)
        low = np.searchsorted(keys, names[blocks] * size + blocks, side="right")
        high = np.searchsorted(keys, names[blocks] * size + np.minimum(blocks + 4 * width, size), side="left")
        counts = high - low
        total = int(counts.sum())
        if not total:
            continue
        firsts = np.repeat(low - np.cumsum(counts) + counts, counts)
        other = keys[firsts + np.arange(total)] % size
        j = np.repeat(blocks, counts)
        d = other - j
        # A block whose predecessor matches at the same distance lies in the same stretch: no run is lost.
        before = j - width
        ok = before >= 0
        at = np.where(ok, before, 0)
        ok &= names[at] == names[np.minimum(at + d, size - 1)]
        ok &= before + d < size
        found_j.append(j[~ok])
        found_d.append(d[~ok])
    if not found_j:
        return np.zeros((0, 3), dtype=np.int64)
    j, d = np.concatenate(found_j), np.concatenate(found_d)
    if not len(j):
        return np.zeros((0, 3), dtype=np.int64)
    right = _extension(forward, j, j + d)
    left = _extension(backward, n - j, n - j - d)
    start, end = j - left, j + right + d
    stretches = np.stack([start, end, d], axis=1)
    # Least period of each maximal stretch.
    stretches = stretches[np.lexsort((stretches[:, 2], stretches[:, 1], stretches[:, 0]))]
    first = np.ones(len(stretches), dtype=bool)
    first[1:] = (stretches[1:, 0] != stretches[:-1, 0]) | (stretches[1:, 1] != stretches[:-1, 1])
    stretches = stretches[first]
    length = stretches[:, 1] - stretches[:, 0]
    kept = stretches[(length >= MIN_LENGTH) & (length >= 2 * stretches[:, 2])]
    out = np.stack([kept[:, 0], kept[:, 1] - kept[:, 0], kept[:, 2]], axis=1)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def find_runs(text: str | None) -> tuple[int, list[dict], str]:
    """Number of words, runs, and the words that no run repeats, joined by one space."""
    words = (text or "").encode().split()  # bytes part at exactly the six white space characters
    if not words:
        return 0, [], ""
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    found = runs_of(ids)
    if not len(found):
        return len(words), [], b" ".join(words).decode()
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, found[:, 0] + found[:, 2], 1)
    np.add.at(cover, found[:, 0] + found[:, 1], -1)
    dropped = np.cumsum(cover[:-1]) > 0
    runs = [{"start": int(s), "length": int(ln), "period": int(p)} for s, ln, p in found]
    return len(words), runs, b" ".join(w for w, gone in zip(words, dropped) if not gone).decode()


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (``start, length, period`` by start, then period) and ``collapsed``.

    Words are maximal stretches without white space (space, tab, line feed, vertical tab, form feed,
    carriage return), numbered from 0. A run is a maximal stretch of words of smallest period q and
    length at least max(12, 2q); neighbouring words do not extend it with period q. ``collapsed``
    holds the words that no run holds after its first q words, joined by one space. A null or
    blank text has no words, no run and an empty ``collapsed``. Rows keep their order and all
    other columns; input columns named like the added ones are replaced. Ties and repeated rows
    give the same values for the same text.
    """
    others = [c for c in docs.columns if c not in ADDED]
    source = docs.select(*others, F.col(text).alias("_periodic_text"))

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(stream):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            found = [find_runs(t) for t in texts]
            kept = pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns,
                 pa.array([f[0] for f in found], pa.int64()),
                 pa.array([f[1] for f in found], pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                 pa.array([f[2] for f in found], pa.string())],
                names=[*kept.schema.names, *ADDED],
            )

    return source.mapInArrow(batches, _schema_of(source.drop("_periodic_text"), ADDED))


def _schema_of(base: DataFrame, added: dict[str, str]) -> StructType:
    schema = StructType(list(base.schema.fields))
    for name, kind in added.items():
        schema = schema.add(name, _parse_datatype_string(kind))
    return schema


def planted(doc_id: Column, text: Column) -> Column:
    """The words of ``text``, with a period planted where the unsigned CRC-32 of the decimal id ends in 0.

    With h that CRC-32, g = floor(h / 10), n words, a = g mod n and p = 1 + floor((n - a) / (3 + g mod 8)),
    word i >= a becomes word a + (i - a) mod p. Words are joined by one space; a text that is not
    edited stays as it is (null too).
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    # Each value that the words' lambda reads is bound once per row; named outside, the text would be split for every word.
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def edited(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))

        def moved(at: Column) -> Column:
            a, p = at["a"], at["p"]
            return F.transform(
                words, lambda w, i: F.when(i >= a, F.element_at(words, (a + F.pmod(i - a, p) + 1).cast("int"))).otherwise(w)
            )

        return F.when(n > 0, F.array_join(let(F.struct(a.alias("a"), p.alias("p")), moved), " ")).otherwise(text)

    return F.when(F.pmod(h, F.lit(10)) == 0, let(words, edited)).otherwise(text)
