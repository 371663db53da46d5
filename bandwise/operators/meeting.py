"""Pairs that meet in a block, compared inside the task that holds both blocks.

Each task compares its signatures tile by tile and gives its pairs on, or only what is counted
of them, so no pair is shuffled or written on the way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from bandwise.functions.bits import WORD_BITS, band_width

TALL, WIDE = 256, 4096
ALL = (1 << WORD_BITS) - 1


@dataclass
class Meeting:
    """How signatures of ``m`` bits meet.

    ``paired`` has the band counts whose buckets are compared, ``bs`` those asked for, ``pieces`` the bits of the
    pieces by which large buckets of a count were keyed further.
    """

    m: int
    bs: list[int]
    paired: list[int]
    max_h: int | None
    pieces: dict[int, int]

    def words_of(self, bits: int) -> list[int]:
        return [(bits >> (w * WORD_BITS)) & ALL for w in range(-(-self.m // WORD_BITS))]

    def band(self, b: int, i: int) -> list[int]:
        r = band_width(self.m, b)
        return self.words_of(((1 << r) - 1) << (i * r))

    def shares(self, xored: list[np.ndarray], b: int, bands: Iterable[int] | None = None) -> np.ndarray:
        """True where both sides agree in one of the ``bands`` of count ``b``, by default in any."""
        bands = range(b) if bands is None else bands
        if len(xored) == 1:
            return _agrees_in_field(xored[0], band_width(self.m, b), bands)
        found = np.zeros(len(xored[0]), bool)
        for i in bands:
            found |= _all_zero(xored, self.band(b, i))
        return found

    def first(self, xored: list[np.ndarray], b: int, at: int, piece: int) -> np.ndarray:
        """True where the pair agrees in this band (and piece) and met in none before, so each pair counts once."""
        keep = _all_zero(xored, self.band(b, at))
        keep &= ~self.shares(xored, b, range(at))
        for c in self.paired:
            if c < b:
                keep &= ~self.shares(xored, c)
        if piece > 0:
            r, width = band_width(self.m, b), self.pieces[b]
            below = np.uint64((1 << (at * r)) - 1)
            rest = (xored[0] & below) | ((xored[0] >> np.uint64(r)) & ~below)
            for q in range(piece):
                keep &= rest & np.uint64(((1 << width) - 1) << (q * width)) != 0
        return keep

    def shared(self, xored: list[np.ndarray], b: int) -> list[np.ndarray]:
        """For each of ``bs`` whether the pair shares a band of that count; it met in a band of count ``b``."""
        return [np.ones(len(xored[0]), bool) if c == b else self.shares(xored, c) for c in self.bs]


def _all_zero(xored: list[np.ndarray], masks: list[int]) -> np.ndarray:
    found = None
    for word, mask in zip(xored, masks, strict=True):
        if mask:
            test = word & np.uint64(mask) == 0
            found = test if found is None else found & test
    return found


def _agrees_in_field(word: np.ndarray, width: int, fields: Iterable[int]) -> np.ndarray:
    """True where one of the ``fields`` of ``width`` bits is zero, tested by one sum: adding all but the highest
    bits of each field carries into its highest bit exactly if a lower one is set."""
    high = sum(1 << (i * width + width - 1) for i in fields)
    low = sum(((1 << (width - 1)) - 1) << (i * width) for i in fields)
    if not high:
        return np.zeros(len(word), bool)
    return (((word & np.uint64(low)) + np.uint64(low)) | word) & np.uint64(high) != np.uint64(high)


def tiles(one: np.ndarray, two: np.ndarray, same: bool, max_h: int | None) -> Iterator[tuple]:
    """Pairs between the signatures of two blocks: their places, XOR words and distances, a tile at a time.

    Of a block with itself (``same``), each two places once. ``max_h`` keeps nearer pairs only.
    """
    for i in range(0, len(one), TALL):
        a = one[i : i + TALL]
        for j in range(i if same else 0, len(two), WIDE):
            c = two[j : j + WIDE]
            words = [a[:, w, None] ^ c[None, :, w] for w in range(a.shape[1])]
            h = np.bitwise_count(words[0])
            if len(words) > 1:
                h = h.astype(np.int16)
                for word in words[1:]:
                    h += np.bitwise_count(word)
            keep = np.ones(h.shape, bool) if max_h is None else h <= max_h
            if same and j < i + len(a):
                keep &= np.arange(j, j + len(c))[None, :] > np.arange(i, i + len(a))[:, None]
            at = np.flatnonzero(keep)
            if len(at):
                left, right = np.divmod(at, len(c))
                yield left + i, right + j, [word.ravel()[at] for word in words], h.ravel()[at].astype(np.int64)


def column_array(column: pa.Array) -> np.ndarray:
    """Numbers as they are, lists of one length as the rows of a matrix."""
    if pa.types.is_list(column.type):
        flat = column.flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(len(column), len(flat) // len(column))
    return column.to_numpy(zero_copy_only=False)


def met_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[dict, dict, dict, bool]]:
    """The key, both blocks as arrays by column, and whether they are one block, for each group of sorted rows."""
    keys, key, held = [*keys, "i", "j"], None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = {name: batch.column(name) for name in batch.schema.names}
        if columns.get("doc_id") is not None:
            columns["no_id"] = columns["doc_id"].is_null()
            columns["doc_id"] = pc.fill_null(columns["doc_id"], 0)
        arrays = {name: column_array(column) for name, column in columns.items()}
        arrays["sig"] = np.ascontiguousarray(arrays["sig"].reshape(batch.num_rows, -1)).view(np.uint64)
        changed = np.zeros(batch.num_rows - 1, bool)
        for name in keys:
            step = arrays[name][1:] != arrays[name][:-1]
            changed |= step.any(axis=1) if step.ndim > 1 else step
        cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            here = tuple(arrays[name][start].tolist() for name in keys)
            if here != key:
                if held:
                    yield _sides(dict(zip(keys, key)), held)
                key, held = here, []
            held.append({name: values[start:stop] for name, values in arrays.items() if name not in keys})
    if held:
        yield _sides(dict(zip(keys, key)), held)


def _sides(key: dict, held: list[dict]) -> tuple[dict, dict, dict, bool]:
    every = {name: np.concatenate([part[name] for part in held]) if len(held) > 1 else held[0][name] for name in held[0]}
    if key["i"] == key["j"]:
        return key, every, every, True
    side = every.pop("side")
    return key, *({name: values[side == at] for name, values in every.items()} for at in (0, 1)), False


def met_blocks(batches: Iterator[pa.RecordBatch], keys: list[str], how: Meeting) -> Iterator[tuple[dict, dict, Iterator]]:
    """The rows of each two blocks, by column, and their pairs as ``places, places, h, shared`` a tile at a time."""
    for key, left, right, same in met_groups(batches, keys):
        if len(left["sig"]) > same and len(right["sig"]):
            yield left, right, block_tiles(left, right, same, key, how)


def block_tiles(left: dict, right: dict, same: bool, key: dict, how: Meeting) -> Iterator[tuple]:
    for one, two, xored, h in tiles(left["sig"], right["sig"], same, how.max_h):
        keep = how.first(xored, key["b"], key["band_idx"], key.get("piece", -1))
        if not keep.all():
            one, two, h, xored = one[keep], two[keep], h[keep], [word[keep] for word in xored]
        if len(one):
            yield one, two, h, how.shared(xored, key["b"])


def met_pairs(batches: Iterator[pa.RecordBatch], keys: list[str], how: Meeting) -> Iterator[tuple]:
    """``left, right, places, places, h, shared`` of every tile of all blocks, see :func:`met_blocks`."""
    for left, right, found in met_blocks(batches, keys, how):
        for tile in found:
            yield left, right, *tile


def met(blocks: DataFrame, keys: list[str], tasks: int, visit: Callable, schema: str) -> DataFrame:
    """What ``visit`` gives for the rows of ``blocks`` (of ``block_pairs``), dealt by key and block over ``tasks``."""
    order = [*keys, "i", "j"]
    return blocks.repartition(tasks, *order).sortWithinPartitions(*order).mapInArrow(visit, schema)


def shared_lists(shared: list[np.ndarray], bs: list[int]) -> pa.Array:
    """The band counts that each pair shares, as lists."""
    table = np.stack(shared, axis=1)
    offsets = np.concatenate([[0], np.cumsum(table.sum(axis=1))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.array(bs, np.int32)[np.nonzero(table)[1]]))


def tile_dots(one: np.ndarray, two: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Dot products of the rows ``at`` of one matrix with the rows ``to`` of another, in double precision."""
    low, high, first, last = at.min(), at.max() + 1, to.min(), to.max() + 1
    if 16 * len(at) > (high - low) * (last - first):
        product = one[low:high].astype(np.float64, copy=False) @ two[first:last].astype(np.float64, copy=False).T
        return product[at - low, to - first]
    return np.einsum("ij,ij->i", one[at].astype(np.float64, copy=False), two[to].astype(np.float64, copy=False))
