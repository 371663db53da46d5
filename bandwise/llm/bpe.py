"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, all others by merging linked bytes off a heap."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm.common import per_process, slices

MEMO_ENTRIES = 300_000
MASK64 = (1 << 64) - 1


class PerfectHash:
    """Minimal perfect hash of byte strings by displacement: n keys fill slots 0..n-1 without a gap.

    Keys fall into buckets of about two. The largest buckets first, each gets a displacement that
    sends its keys to free slots; buckets of one key name a free slot outright (as -1 - slot).
    """

    def __init__(self, keys: list[bytes]):
        self.size = len(keys)
        self.buckets = max(1, len(keys) // 2)
        hashes = [xxhash.xxh64_intdigest(key) for key in keys]
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        for h in hashes:
            members[h % self.buckets].append(h)
        self.shift = [0] * self.buckets
        taken = bytearray(self.size)
        order = sorted(range(self.buckets), key=lambda b: -len(members[b]))
        free = None
        for b in order:
            if not members[b]:
                break
            if len(members[b]) == 1:
                free = iter([s for s in range(self.size) if not taken[s]]) if free is None else free
                self.shift[b] = -1 - next(free)
                continue
            d = 0
            while True:
                spots = {self.spot(h, d) for h in members[b]}
                if len(spots) == len(members[b]) and not any(taken[s] for s in spots):
                    break
                d += 1
            self.shift[b] = d
            for s in spots:
                taken[s] = 1

    def spot(self, h: int, d: int) -> int:
        return (((h >> 20) ^ (d * 0x9E3779B97F4A7C15)) * 0xD6E8FEB86659FD93 & MASK64) % self.size

    def slot(self, key: bytes) -> int:
        h = xxhash.xxh64_intdigest(key)
        d = self.shift[h % self.buckets]
        return self.spot(h, d) if d >= 0 else -1 - d


class ByteBPE:
    """Encodes and decodes by the ranks of a vocabulary in which every single byte has one.

    Results equal those of the tiktoken library without special tokens.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pieces = regex.compile(pattern).findall
        self.hash = PerfectHash(list(ranks))
        self.slots: list[tuple[bytes, int]] = [(b"", -1)] * len(ranks)
        for token, rank in ranks.items():
            self.slots[self.hash.slot(token)] = (token, rank)
        self.byte_pairs = {(token[0], token[1]): rank for token, rank in ranks.items() if len(token) == 2}
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.decimal = {rank: str(rank) for rank in self.tokens}
        self.memo: dict[str, tuple[int, ...]] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        # White space on both sides of a space: only there a run reaches from one space-separated part into another.
        self.runs = re.compile(r"\s (?:\s|\Z)").search

    def piece(self, text: str) -> tuple[int, ...]:
        """Ids of one pre-token."""
        data = text.encode()
        token, rank = self.slots[self.hash.slot(data)]
        return (rank,) if token == data else self.merged(data)

    def merged(self, data: bytes) -> tuple[int, ...]:
        """Merge the adjacent parts of lowest rank, leftmost first, until no two parts make a token.

        ``after[i]`` is where the part that starts at byte i ends; 0 once that part has been merged away.
        """
        n, rank, pairs = len(data), self.ranks.get, self.byte_pairs
        after = list(range(1, n + 1))
        after.append(n)
        before = list(range(-1, n))
        heap = [r << 32 | i for i, pair in enumerate(zip(data, data[1:])) if (r := pairs.get(pair)) is not None]
        heapify(heap)
        while heap:
            best = heappop(heap)
            left = best & 0xFFFFFFFF
            right = after[left]
            if right <= left or right == n:
                continue
            end = after[right]
            if rank(data[left:end]) != best >> 32:
                continue  # one of the two has grown meanwhile
            after[right], after[left], before[end] = 0, end, left
            if end < n and (r := rank(data[left : after[end]])) is not None:
                heappush(heap, r << 32 | left)
            prior = before[left]
            if prior >= 0 and (r := rank(data[prior:end])) is not None:
                heappush(heap, r << 32 | prior)
        out, at = [], 0
        while at < n:
            end = after[at]
            out.append(self.ranks[data[at:end]])
            at = end
        return tuple(out)

    def part(self, text: str) -> tuple[int, ...]:
        """Ids of a text, pre-token by pre-token; the first ``MEMO_ENTRIES`` different ones are remembered."""
        words, out = self.words, []
        for word in self.pieces(text):
            ids = words.get(word)
            if ids is None:
                ids = self.piece(word)
                if len(words) < MEMO_ENTRIES and len(word) < 64:
                    words[word] = ids
            out.append(ids)
        return out[0] if len(out) == 1 else tuple(chain.from_iterable(out))

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text. A null text counts as empty.

        A space opens a new pre-token unless white space meets it on both sides, so parts between
        spaces are encoded on their own and remembered; other texts are cut by the pattern whole.
        """
        if not text:
            return []
        if self.runs(text):
            return list(self.part(text))
        first, *rest = text.split(" ")
        memo = self.memo
        parts = list(map(memo.get, rest))
        if None in parts:
            room = len(memo) < MEMO_ENTRIES
            for i, word in enumerate(rest):
                if parts[i] is None:
                    ids = memo.get(word) or self.part(" " + word)
                    if room and len(word) < 64:
                        memo[word] = ids
                    parts[i] = ids
        ids = list(self.part(first))
        ids.extend(chain.from_iterable(parts))
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def digest(self, ids: list[int]) -> str:
        return hashlib.sha256(" ".join(map(self.decimal.__getitem__, ids)).encode()).hexdigest()


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file: a token in base64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def codec(ranks_path: str, pattern: str):
    """What gives each worker its ``ByteBPE``. The file is read here, once, and sent to the workers."""
    ranks = read_ranks(ranks_path)
    key = f"bpe {ranks_path} {len(ranks)} {pattern}"
    return ranks, lambda known: per_process(key, lambda: ByteBPE(known, pattern))


def with_ids(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the token ids of ``text`` as an array in the new column ``ids``; null texts get an empty array.

    The other columns pass unchanged, also repeated rows and null keys; a column of the name
    ``ids`` is replaced. Nothing is shuffled.
    """
    spark = docs.sparkSession
    ranks, build = codec(ranks_path, pattern)
    shared = spark.sparkContext.broadcast(ranks)

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = build(shared.value)
        for batch in batches:
            yield pa.array([bpe.encode(x) for x in batch.to_pylist()], pa.list_(pa.int32()))

    return docs.withColumn(ids, encode(text))


def with_text(tokens: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``tokens`` with the bytes that ``ids`` stand for in the new column ``decoded``; null arrays decode to no bytes.

    Ids outside the vocabulary are an error.
    """
    spark = tokens.sparkSession
    ranks, build = codec(ranks_path, pattern)
    shared = spark.sparkContext.broadcast(ranks)

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = build(shared.value)
        for batch in batches:
            yield pa.array([bpe.decode(x or []) for x in batch.to_pylist()], pa.binary())

    return tokens.withColumn(decoded, decode(ids))


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document, encoded and decoded in one pass.

    Digests replace the ids and bytes inside the task, so only they travel on. Null texts count
    as empty, null or repeated ids keep their rows, other columns are ignored.
    """
    ranks, build = codec(ranks_path, pattern)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = build(shared.value)
        for batch in slices(batches):
            counts, encoded, decoded = [], [], []
            for text in batch.column(1).to_pylist():
                ids = bpe.encode(text)
                counts.append(len(ids))
                encoded.append(bpe.digest(ids))
                decoded.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return kept.mapInArrow(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
