import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import sign_bits

from bandwise.functions.bits import bit_range, hamming, prefix_signature
from bandwise.functions.simhash import hyperplanes, simhash, with_norm, with_simhash
from bandwise.operators.banding import band_keys, bucket_sizes


def as_bits(sig, m):
    words = sig if isinstance(sig, list) else [sig]
    return [(words[j // 64] >> (j % 64)) & 1 for j in range(m)]


@pytest.mark.parametrize("m", [1, 7, 63, 64, 65, 100, 128, 200])
def test_signature_bits_follow_plane_order(table, clustered, m):
    rows = with_simhash(table(clustered), m).select("doc_id", "sig").collect()
    bits = sign_bits(clustered, m)
    assert {r.doc_id: as_bits(r.sig, m) for r in rows} == {i: list(b) for i, b in enumerate(bits)}


def test_planes_of_a_longer_signature_start_with_the_shorter_ones():
    assert np.array_equal(hyperplanes(128, 9)[:64], hyperplanes(64, 9))


def test_prefix_signature(table, clustered):
    wide = with_simhash(table(clustered), 200)
    for m in (20, 64, 70, 128):
        short = wide.select("doc_id", prefix_signature("sig", 200, m).alias("sig")).collect()
        direct = with_simhash(table(clustered), m).select("doc_id", "sig").collect()
        assert sorted(short) == sorted(direct)


def test_zero_and_missing_vectors(table):
    rows = with_simhash(table([[0.0, 0.0], None, [1.0, 2.0]]), 64).orderBy("doc_id").collect()
    assert rows[0].sig == 0 and rows[1].sig is None and rows[2].sig is not None
    norms = with_norm(table([[3.0, 4.0], [0.0, 0.0]])).orderBy("doc_id").collect()
    assert [r.norm for r in norms] == [5.0, 0.0]


def test_vector_length_is_checked(table):
    with pytest.raises(Exception, match="same length"):
        with_simhash(table([[1.0, 2.0], [1.0]]).coalesce(1)).collect()
    with pytest.raises(Exception, match="not of length 3"):
        with_simhash(table([[1.0, 2.0]]), dim=3).collect()


def test_empty_table(table):
    assert with_simhash(table([[1.0]]).where("false")).select("sig").collect() == []


def test_row_order_does_not_matter(table, clustered):
    ids = list(range(len(clustered)))
    forward = with_simhash(table(clustered, ids)).select("doc_id", "sig").collect()
    backward = with_simhash(table(clustered[::-1], ids[::-1])).select("doc_id", "sig").collect()
    assert sorted(forward) == sorted(backward)


@pytest.mark.parametrize("m,b", [(64, 1), (64, 4), (64, 64), (64, 7), (100, 9), (128, 10), (200, 2), (130, 1)])
def test_band_keys_partition_like_bit_slices(table, clustered, m, b):
    r = m // b
    rows = band_keys(with_simhash(table(clustered), m).select("doc_id", "sig"), m, [b]).collect()
    bits = sign_bits(clustered, m)
    assert len(rows) == len(clustered) * b
    for row in rows:
        values = row.band_val if isinstance(row.band_val, list) else [row.band_val]
        got = [(values[j // 64] >> (j % 64)) & 1 for j in range(r)]
        assert got == list(bits[row.doc_id][row.band_idx * r : (row.band_idx + 1) * r])
    assert sum(r.bucket_size for r in bucket_sizes(band_keys(with_simhash(table(clustered), m), m, [b])).collect()) == len(rows)


def test_bit_range_and_hamming(spark):
    rng = np.random.default_rng(3)
    words = [[int(x) for x in rng.integers(-(2**63), 2**63 - 1, 3)] for _ in range(20)]
    df = spark.createDataFrame([(w, w[::-1]) for w in words], "a array<bigint>, b array<bigint>")
    whole = [sum((x & (2**64 - 1)) << (64 * i) for i, x in enumerate(w)) for w in words]
    for start, width in ((0, 64), (5, 10), (60, 12), (63, 2), (64, 64), (100, 64), (128, 64), (191, 1)):
        got = df.select(F.expr(bit_range("a", 192, start, width)).alias("x")).collect()
        assert [r.x & (2**64 - 1) for r in got] == [(w >> start) & ((1 << width) - 1) for w in whole]
    got = [r.h for r in df.select(F.expr(hamming("a", "b", 192)).alias("h")).collect()]
    assert got == [sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(w, w[::-1])) for w in words]


def test_other_seed_gives_other_planes(table, clustered):
    df = table(clustered)
    assert df.select(simhash("vec", 64, 1).alias("s")).collect() != df.select(simhash("vec", 64, 2).alias("s")).collect()


def test_planes_are_the_fixed_draw():
    # The first draws of seed 42.
    expected = [[0.4967141530112327, -0.13826430117118466], [0.6476885381006925, 1.5230298564080254]]
    assert np.allclose(hyperplanes(2, 2, 42), expected, rtol=0, atol=1e-15)
