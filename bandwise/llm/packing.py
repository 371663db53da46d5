"""Best-fit packing of token sequences: a bounded number of open bins in a bitset keyed by free space."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bandwise.llm.bpe import read_ranks
from bandwise.llm.common import per_process, slices

LENGTH = 2048
OPEN_BINS = 4096
SORTED_PIECES = 16_384
TASK_PIECES = 100_000
LONG_SPACE = 10_000
END = 0


class Encoder:
    """Ids by the tokenizers library, without special tokens added.

    Most texts are encoded by tiktoken with the same vocabulary as ranks, which gives the same ids in less
    time. Those that hold an added token, or white space that its pattern cannot cross, go to tokenizers.
    """

    def __init__(self, json: str, ranks: dict[bytes, int], pattern: str):
        self.tokenizer = Tokenizer.from_str(json)
        self.quick = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        added = [re.escape(x.content) for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.other = re.compile("|".join([rf"\s{{{LONG_SPACE}}}", *added])).search

    def ids(self, text: str | None) -> np.ndarray:
        """Ids as unsigned 32-bit numbers; null counts as empty."""
        if not text:
            return np.empty(0, np.uint32)
        if self.other(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.quick.encode_to_numpy(text, disallowed_special=())


def pieces(
    docs: DataFrame, tokenizer_path: str, ranks_path: str, pattern: str, length: int = LENGTH, with_ids: bool = True
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and on request ``ids`` of every document: its ids and a closing id 0.

    Null texts count as empty and give the closing id alone. A document of more than ``length`` ids is
    cut into full pieces after a first piece that may be shorter, so only one piece of each needs a partner.

    Ids are those of the file at ``tokenizer_path``. ``ranks_path`` is the same vocabulary as ranks and ``pattern``
    the pattern of its pre-tokens.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        json = file.read()
    shared = docs.sparkSession.sparkContext.broadcast((json, read_ranks(ranks_path)))
    key = f"tokenizer {tokenizer_path} {len(json)}"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process(key, lambda: Encoder(*shared.value, pattern))
        for batch in slices(batches, 64):
            at, rows = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                data = encoder.ids(text).astype("<u4").tobytes() + END.to_bytes(4, "little")
                total = len(data) // 4
                first = (total - 1) % length + 1
                starts = [0, *range(first, total, length)]
                for k, (s, e) in enumerate(zip(starts, [*starts[1:], total])):
                    part = data[4 * s : 4 * e]
                    at.append(i)
                    rows.append((k, s, e - s, zlib.crc32(part), part))
            columns = list(zip(*rows)) if rows else [()] * 5
            arrays = [
                batch.column(0).take(pa.array(at, pa.int64())),
                pa.array(columns[0], pa.int32()),
                *(pa.array(c, pa.int64()) for c in columns[1:4]),
            ]
            if with_ids:
                ids = np.frombuffer(b"".join(columns[4]), "<u4").astype(np.int32)
                offsets = np.concatenate([[0], np.cumsum(columns[2], dtype=np.int64)]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)))
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    names = [field.split()[0] for field in schema.split(", ")]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


class OpenBins:
    """At most ``limit`` open bins. Bit f of ``free`` is set while a bin with f free places is open."""

    def __init__(self, size: int, limit: int):
        self.size, self.limit = size, limit
        self.free = 0
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]
        self.open = self.made = 0

    def put(self, length: int) -> tuple[int, int]:
        """The bin and the offset for a piece: the open bin it fills best, else a new one."""
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number = self.bins[space].pop()
            if not self.bins[space]:
                self.free &= ~(1 << space)
            self.open -= 1
        else:
            space, number = self.size, self.made
            self.made += 1
        left = space - length
        if left:
            if self.open == self.limit:  # the fullest open bin closes first, maybe this one
                least = (self.free & -self.free).bit_length() - 1
                if left <= least:
                    return number, self.size - space
                self.bins[least].pop()
                if not self.bins[least]:
                    self.free &= ~(1 << least)
                self.open -= 1
            self.bins[left].append(number)
            self.free |= 1 << left
            self.open += 1
        return number, self.size - space


def packed(
    parts: DataFrame, length: int = LENGTH, open_bins: int = OPEN_BINS, ahead: int = SORTED_PIECES, task_pieces: int = TASK_PIECES
) -> DataFrame:
    """``parts``, the columns of ``pieces`` but the ids, with ``sequence_id`` and ``offset``.

    If ``parts`` has ids and a ``row``, a number of its own for each row, the result has the ids too, and no ``row``:
    only the other columns go through packing, and the ids are joined to their places.

    ``parts`` is read several times, so give a written table.

    Full pieces are sequences of their own and move nowhere. All others are dealt by hash to tasks of
    about ``task_pieces``, each of which packs its stream online with ``open_bins`` open bins;
    it looks ``ahead`` pieces ahead and takes them longest first. Each task leaves some bins
    partly filled, so tasks are many only where pieces are. The order is fixed by hash and key, so a repeated task
    gives the same sequences. Null ids and repeated rows are packed like any other.
    """
    if "ids" in parts.columns and "row" in parts.columns:
        places = packed(parts.drop("ids"), length, open_bins, ahead, task_pieces)
        return parts.join(places.select("row", "sequence_id", "offset"), "row").drop("row")
    light = [c for c in parts.columns if c != "ids"]
    row = ["row"] if "row" in light else []
    schema = parts.select(*light).schema.add("sequence_id", "long").add("offset", "long")
    at = light.index("length")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(length, open_bins)
        base, held, count = None, [], 0

        def flush() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            lengths = table.column(at + 1).to_numpy()
            places = np.empty((len(lengths), 2), np.int64)
            for i in np.argsort(-lengths, kind="stable").tolist():
                places[i] = bins.put(int(lengths[i]))
            return pa.RecordBatch.from_arrays(
                [*table.columns[1:], pa.array(places[:, 0] * tasks + base), pa.array(places[:, 1])], names
            )

        for batch in batches:
            if batch.num_rows == 0:
                continue
            base = batch.column(0)[0].as_py() if base is None else base
            held.append(batch)
            count += batch.num_rows
            if count >= ahead:
                yield flush()
                held, count = [], 0
        if held:
            yield flush()

    names = [f.name for f in schema]
    full = F.col("length") >= length
    n = parts.where(~full).count()
    tasks = max(1, -(-n // task_pieces))
    deal = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(tasks))
    loose = parts.where(~full).select(deal.alias("task"), *light).repartitionByRange(tasks, "task")
    loose = loose.sortWithinPartitions("task", F.xxhash64("doc_id", "piece", F.lit(1)), "doc_id", "piece", "start", "length", *row)
    small = loose.mapInArrow(pack, schema)
    # Full pieces get negative numbers, apart from those of the packed ones.
    number = F.col("row") if row else F.monotonically_increasing_id()
    own = parts.where(full).select(
        *light, (-1 - number).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return small.unionByName(own)
