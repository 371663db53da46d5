import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from odd import ODD
from tokenizers import Tokenizer

from bandwise.llm import bpe, packing

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
LETTERS = "ab é\n \t'sl世　\x1c\x85 12.\r!<|endoftext|>🙂"


@pytest.fixture(scope="module")
def codec():
    ranks = bpe.read_ranks(RANKS)
    return bpe.ByteBPE(ranks, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_those_of_tiktoken(codec):
    ours, theirs = codec
    rng = random.Random(1)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(30))) for _ in range(5000)]
    for text in [*texts, "x" * 5000, "ab" * 3000, "\n" * 500 + "a"]:
        ids = ours.encode(text)
        assert ids == theirs.encode_ordinary(text), text
        assert ours.decode(ids) == text.encode()


def test_perfect_hash_is_minimal(codec):
    ours, _ = codec
    assert sorted(ours.hash.slot(t) for t in ours.ranks) == list(range(len(ours.ranks)))
    assert ours.hash.slot(b"certainly not a token") < len(ours.ranks)


def test_columns_and_digests(docs, codec):
    table = docs(ODD, [5, None, 5, 7, 7, 8, 9])
    rows = bpe.with_text(bpe.with_ids(table, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert [r.ids for r in rows] == [codec[1].encode_ordinary(t or "") for t in ODD]
    assert [bytes(r.decoded) for r in rows] == [(t or "").encode() for t in ODD]
    assert bpe.round_trip(table, RANKS, P.PATTERN).count() == len(ODD)
    assert bpe.round_trip(table.where("false"), RANKS, P.PATTERN).count() == 0


def test_both_encoders_agree():
    with open(JSON, encoding="utf-8") as file:
        encoder = packing.Encoder(file.read(), bpe.read_ranks(RANKS), P.PATTERN)
    rng = random.Random(2)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(rng.choice(every if rng.random() < 0.5 else LETTERS) for _ in range(40)) for _ in range(2000)]
    for text in [*texts, "a" + "\n" * 300_000 + "b", "x <|endoftext|>y", "ab" * 3000, ""]:
        assert encoder.ids(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder.ids(None).tolist() == []


def test_pieces_and_packing(docs, spark):
    rng = random.Random(3)
    texts = [*ODD, *(" ".join(rng.choice(["one", "ninety", "<|endoftext|>", "ß"]) for _ in range(rng.randrange(400))) for _ in range(150))]
    table = docs(texts)
    parts = packing.pieces(table, JSON, RANKS, P.PATTERN, 128)
    encode = Tokenizer.from_file(JSON).encode
    by_doc = {}
    for r in parts.orderBy("doc_id", "piece").collect():
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(texts):
        ids = [*encode(text or "", add_special_tokens=False).ids, 0]
        assert [x for r in by_doc[i] for x in r.ids] == ids
        assert all(r.length == 128 for r in by_doc[i][1:]) and by_doc[i][0].start == 0
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in by_doc[i])
    light = spark.createDataFrame(parts.drop("ids").collect(), parts.drop("ids").schema)
    for task_pieces, open_bins in ((10_000, 64), (20, 2)):
        rows = packing.packed(light, 128, open_bins, 16, task_pieces).collect()
        assert sorted(tuple(r)[:5] for r in rows) == sorted(map(tuple, light.collect()))
        places = {}
        for r in rows:
            places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for held in places.values():
            held.sort()
            assert [o for o, _ in held] == np.cumsum([0, *(n for _, n in held)])[:-1].tolist() and sum(n for _, n in held) <= 128
    assert packing.packed(light.where("false")).count() == 0


def test_the_fullest_bin_closes_first():
    bins = packing.OpenBins(10, 2)
    assert [bins.put(n) for n in (4, 5, 6, 6, 4, 10)] == [(0, 0), (0, 4), (1, 0), (2, 0), (2, 6), (3, 0)]
    bins = packing.OpenBins(10, 1)
    assert [bins.put(n) for n in (8, 6, 2, 4)] == [(0, 0), (1, 0), (1, 6), (2, 0)]
