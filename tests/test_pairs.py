import numpy as np
import pytest
from brute import candidates, quality, scored, sign_bits
from pyspark.sql import functions as F

from bandwise.functions.simhash import with_simhash
from bandwise.operators import pairs as P
from bandwise.operators.pairs import candidate_count, candidate_pairs
from bandwise.plans.quality import quality_by_k, similar_docs_by_k
from bandwise.plans.similar import similar_pairs


def found(df, b):
    rows = [(r.d1, r.d2) for r in df.where(F.col("b") == b).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("m,bs", [(64, [4, 8]), (64, [16]), (100, [7, 10]), (128, [2, 10]), (192, [2, 24])])
def test_candidates_match_brute_force(table, clustered, m, bs):
    bits = sign_bits(clustered, m)
    signatures = with_simhash(table(clustered), m).select("doc_id", "sig")
    every = candidate_pairs(signatures, m, bs)
    near = candidate_pairs(signatures, m, bs, max_h=6)
    counts = {r.b: r.candidates for r in candidate_count(signatures, m, bs).collect()}
    listed = {r.b: r.candidates for r in candidate_count(signatures, m, bs, subset_bands=0).collect()}
    for b in bs:
        expected = candidates(bits, b)
        assert found(every, b) == expected
        assert counts[b] == listed[b] == len(expected)
        assert found(near, b) == {(i, j) for i, j in expected if (bits[i] != bits[j]).sum() <= 6}


def test_counts_by_band_sets_form_no_pair(table, clustered):
    """Inclusion-exclusion: one aggregation over masked signatures, no join of signatures with each other."""
    signatures = with_simhash(table(clustered), 64).select("doc_id", "sig")
    groups = P.signature_groups(signatures)
    assert "Join" not in P.agreeing_counts(groups, 64, [4, 8])._jdf.queryExecution().executedPlan().toString()
    counted = candidate_count(signatures, 64, [4, 8])
    bits = sign_bits(clustered, 64)
    assert {r.b: r.candidates for r in counted.collect()} == {b: len(candidates(bits, b)) for b in (4, 8)}


def test_band_sets_hold_every_set_once():
    sets = P.band_sets(64, [3])
    assert len(sets) == 7 and sum(sign for _, sign, _ in sets) == 1
    masks = {masks[0] & (2**64 - 1) for _, _, masks in sets}
    assert (1 << 42) - 1 in masks and len(masks) == 7


def test_pairs_are_counted_exactly(spark):
    sizes = spark.createDataFrame([(2**53 + 3, 1, 134_217_731)], "a long, b long, c long")
    row = sizes.select(P.pair_count("a", "b").alias("across"), P.pair_count("c").alias("inside")).first()
    assert int(row.across) == 2**53 + 3
    assert int(row.inside) == 134_217_731 * 134_217_730 // 2


@pytest.mark.parametrize("max_h,block_rows", [(None, 20), (0, 20), (1, 20), (3, 20), (6, 20), (6, 2)])
def test_hot_buckets_are_split_without_losing_pairs(spark, monkeypatch, max_h, block_rows):
    """A band shared by everyone, near copies inside it, and tiny limits that force every kind of split."""
    monkeypatch.setattr(P, "REFINE_BLOCKS", 4)
    rng = np.random.default_rng(11)
    centers = rng.integers(0, 2**62, 40)
    sigs = {int((c ^ (1 << int(f))) & ~0xFFFF) | 0x1234 for c in centers for f in rng.integers(16, 60, 8)}
    groups = spark.createDataFrame([(s, 1) for s in sigs], "sig long, n long")
    got = [tuple(r) for r in P.signature_pairs(groups, 64, [3, 4, 8], max_h, block_rows=block_rows).collect()]
    unordered = {(frozenset(r[:2]), r[2], tuple(r[3])) for r in got}
    assert len(unordered) == len(got)
    ordered = sorted(sigs)
    expected = set()
    for at, x in enumerate(ordered):
        for y in ordered[at + 1 :]:
            z, bs = x ^ y, []
            for b in (3, 4, 8):
                r = 64 // b
                if any((z >> (i * r)) & ((1 << r) - 1) == 0 for i in range(b)):
                    bs.append(b)
            if bs and (max_h is None or z.bit_count() <= max_h):
                expected.add((frozenset((x, y)), z.bit_count(), tuple(bs)))
    assert unordered == expected


def test_documents_of_a_hot_signature_are_salted(spark):
    docs = [(i, 7 if i % 3 else i) for i in range(90)]
    signatures = spark.createDataFrame(docs, "doc_id long, sig long")
    groups = P.signature_groups(signatures)
    pairs = P.signature_pairs(groups, 64, [8], 6).unionByName(P.same_signature(groups, [8]))
    for rows in (4, 1000):
        got = sorted((r.d1, r.d2, r.h) for r in P.expand_pairs(pairs, groups, signatures, rows).collect())
        expected = [
            (i, j, (s ^ t).bit_count())
            for i, s in docs for j, t in docs if i < j and (s ^ t).bit_count() <= 6
        ]
        assert got == sorted(expected)


def test_few_differing_bits_always_share_a_band(table, clustered):
    bits = sign_bits(clustered, 64)
    signatures = with_simhash(table(clustered)).select("doc_id", "sig")
    for b, k in ((8, 7), (4, 3)):
        near = {
            (i, j) for i in range(len(bits)) for j in range(i + 1, len(bits)) if (bits[i] != bits[j]).sum() <= k
        }
        assert found(candidate_pairs(signatures, 64, [b], max_h=k), b) == near


def test_similar_pairs_and_quality(table, clustered):
    bits, ks, bs = sign_bits(clustered, 64), [0, 2, 4, 8, 20], [4, 8]
    pairs = similar_pairs(table(clustered), 64, bs, max(ks))
    rows = pairs.collect()
    table_rows = {(r.b, r.k): r for r in quality_by_k(pairs, ks, 64, bs).collect()}
    docs = {(r.b, r.k): r.num_docs for r in similar_docs_by_k(pairs.drop("cos"), ks, 64, bs).collect()}
    for b in bs:
        expected = [r for r in scored(clustered, bits, candidates(bits, b)) if r[2] <= max(ks)]
        got = sorted((r.d1, r.d2, r.h, r.cos) for r in rows if r.b == b)
        assert [g[:3] for g in got] == [e[:3] for e in expected]
        assert np.allclose([g[3] for g in got], [e[3] for e in expected], atol=1e-6)
        last = 0
        for k, measures in quality(expected, ks, 64).items():
            r = table_rows[b, k]
            assert np.allclose(
                (r.num_docs, r.num_pairs, r.mean_cosine, r.mean_hamming, r.cosine_hamming), measures, atol=1e-6
            )
            assert docs[b, k] == r.num_docs >= last
            last = r.num_docs


def test_thresholds_without_pairs_give_zero_rows(table):
    far = table(np.eye(8))
    rows = quality_by_k(similar_pairs(far, 64, [4], 0), [0], 64, [4, 8]).orderBy("b").collect()
    assert [tuple(r) for r in rows] == [(b, 64, 0, 0, 0, 0.0, 0.0, 0.0) for b in (4, 8)]


def test_exact_copies(table):
    vec = np.random.default_rng(1).standard_normal(12)
    rows = quality_by_k(similar_pairs(table([vec] * 6), 64, [8], 0), [0], 64, [8]).collect()
    assert (rows[0].num_docs, rows[0].num_pairs, rows[0].cosine_hamming) == (6, 15, 1.0)
    assert abs(rows[0].mean_cosine - 1) < 1e-9


def test_zero_vectors_have_no_cosine(table):
    pairs = similar_pairs(table([[0.0, 0.0], [0.0, 0.0], [1.0, 1.0]]), 64, [8], 64)
    assert {r.cos for r in pairs.where("h = 0").collect()} == {None}
    assert quality_by_k(pairs, [0], 64, [8]).first().mean_cosine is None


def test_missing_vectors_form_no_pairs(table):
    vectors = table([None, None, [1.0, 2.0], [1.0, 2.0]])
    assert [(r.d1, r.d2) for r in similar_pairs(vectors, 64, [8], None).collect()] == [(2, 3)]
    signatures = with_simhash(vectors).select("doc_id", "sig")
    assert candidate_count(signatures, 64, [8]).first().candidates == 1


@pytest.mark.parametrize("rows", [0, 1])
def test_tiny_tables(table, rows):
    one = table([[1.0, 2.0]]).limit(rows) if rows else table([[1.0, 2.0]]).where("false")
    assert similar_pairs(one, 64, [8], 8).collect() == []


def test_vectors_that_are_not_finite_form_no_pairs(table):
    vectors = table([[float("nan")] * 2, [0.0, float("inf")], [0.0, 0.0], [0.0, 0.0]])
    assert [(r.d1, r.d2) for r in similar_pairs(vectors, 64, [8], None).collect()] == [(2, 3)]


def test_vectors_of_another_length_are_an_error(spark):
    rows = [(i, [1.0] * (5 if i == 900 else 8)) for i in range(1000)]
    vectors = spark.createDataFrame(rows, "doc_id long, vec array<float>").repartition(7)
    with pytest.raises(Exception, match="length"):
        similar_pairs(vectors, 64, [8], 0).collect()


def test_pairs_leave_their_blocks_finished(table, clustered):
    """No pair is joined or shuffled: nothing but a projection stands above the comparison of blocks."""
    for pairs in (similar_pairs(table(clustered), 64, [4, 8], 24), candidate_pairs(with_simhash(table(clustered)), 64, [4, 8])):
        above = pairs._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]
        assert "Exchange" not in above and "Join" not in above


@pytest.mark.parametrize("m,bs", [(64, [4, 8, 16]), (128, [10, 16])])
def test_small_blocks_lose_no_pair(table, clustered, m, bs):
    bits, signatures = sign_bits(clustered, m), with_simhash(table(clustered), m).select("doc_id", "sig")
    pairs = P.document_pairs(signatures, m, bs, block_rows=7).select(F.explode("bs").alias("b"), "d1", "d2")
    for b in bs:
        assert found(pairs, b) == candidates(bits, b)


def test_sets_are_counted_by_bounded_tasks(table, clustered, monkeypatch):
    monkeypatch.setattr(P, "TASK_SETS", 500)
    groups = P.signature_groups(with_simhash(table(clustered)).select("doc_id", "sig"))
    tasks = groups.count() * 270 // 500
    counted = P.agreeing_counts(groups, 64, [4, 8])
    assert "hashpartitioning(set_id#" in counted._jdf.queryExecution().executedPlan().toString()
    assert f", {tasks}), REPARTITION_BY_NUM" in counted._jdf.queryExecution().executedPlan().toString()
    bits = sign_bits(clustered, 64)
    assert {r.b: int(r.pairs) for r in counted.collect()} == {b: len(candidates(bits, b)) for b in (4, 8)}
