import numpy as np
import pytest
from brute import candidates, quality, scored, sign_bits

from bandwise.durable import durable, release, written_tables
from bandwise.plans.report import growth_curves, largest_n, representative_k, scaling_exponent
from bandwise.plans.sweep import run_sweep, sweep
from bandwise.sources.sinks import finished_sizes, write_pairs, write_quality

KS = [0, 2, 6, 20]


def test_one_run_for_all_sizes_equals_a_run_per_size(table, clustered):
    ns, ms, bs = [30, 75, len(clustered)], [32, 64, 128], [4, 8]
    got = {(r.n, r.m, r.b, r.k): r for r in sweep(table(clustered), ns, ms, bs, KS).collect()}
    assert len(got) == len(ns) * len(ms) * len(bs) * len(KS)
    for n in ns:
        for m in ms:
            bits = sign_bits(clustered[:n], m)
            for b in bs:
                rows = scored(clustered[:n], bits, candidates(bits, b))
                for k, measures in quality(rows, KS, m).items():
                    r = got[n, m, b, k]
                    assert np.allclose(
                        (r.num_docs, r.num_pairs, r.mean_cosine, r.mean_hamming, r.cosine_hamming), measures, atol=1e-6
                    ), (n, m, b, k)


def test_zero_vectors_in_the_uncapped_sweep(table):
    vectors = table([[0.0, 0.0], [0.0, 0.0], [1.0, 1.0], [1.0, 1.0]])
    row = sweep(vectors, [4], bs=[8], ks=[0]).first()
    assert (row.num_docs, row.num_pairs) == (4, 2)
    assert abs(row.mean_cosine - 1) < 1e-9


def test_uncapped_sweep_beyond_the_broadcast_limits(table, clustered, monkeypatch):
    from bandwise import durable as D
    from bandwise.plans import quality as Q

    few = {tuple(r)[:6] for r in sweep(table(clustered), [75, 150], ks=KS).collect()}
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(Q, "BROADCAST_BYTES", 0)
    assert {tuple(r)[:6] for r in sweep(table(clustered), [75, 150], ks=KS).collect()} == few


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_run_continues_where_it_stopped(spark, table, clustered, tmp_path, fmt):
    path, vectors = str(tmp_path / "quality"), table(clustered)
    assert finished_sizes(spark, path, fmt) == set()
    first = run_sweep(vectors, [40], path, fmt, ks=KS)
    kept = {tuple(r) for r in first.collect()}
    both = run_sweep(vectors, [40, 150], path, fmt, ks=KS)
    assert both.columns[:8] == ["n", "b", "m", "k", "num_docs", "time_sec", "mean_cosine", "cosine_hamming"]
    assert finished_sizes(spark, path, fmt) == {40, 150}
    rows = {tuple(r) for r in both.collect()}
    assert kept < rows and len(rows) == 2 * 2 * len(KS)
    write_quality(both.where("n = 40"), str(tmp_path / "again"), fmt)
    assert finished_sizes(spark, str(tmp_path / "again"), fmt) == {40}


def test_intermediate_tables_are_released(spark, table, clustered, tmp_path):
    before = set(written_tables())
    run_sweep(table(clustered), [60], str(tmp_path / "quality"), ks=KS).collect()
    assert set(written_tables()) == before
    folder = spark.conf.get("spark.checkpoint.dir")
    assert all(path.startswith(folder) for path in before)
    kept = durable(table(clustered), "kept")
    assert kept.count() == len(clustered)
    release([path for path in written_tables() if path not in before])
    assert set(written_tables()) == before


def test_scored_pair_table(spark, table, clustered, tmp_path):
    from bandwise.plans.similar import similar_pairs

    pairs = similar_pairs(table(clustered), 64, [4, 8], 8)
    written = write_pairs(pairs, str(tmp_path / "pairs"))
    assert written.columns == pairs.columns
    assert sorted(map(tuple, written.select("b", "d1", "d2", "h").collect())) == sorted(
        map(tuple, pairs.select("b", "d1", "d2", "h").collect())
    )


def test_reports(spark):
    rows = [(n, b, 64, k, float(n) ** a) for n in (10, 100, 1000) for b, a in ((4, 1.0), (8, 1.5)) for k in (0, 2, 4, 8)]
    measured = spark.createDataFrame(rows, "n long, b int, m int, k int, time_sec double")
    assert {r.n for r in largest_n(measured).collect()} == {1000}
    middle = representative_k(measured, [0, 2, 4, 8])
    assert [(r.b, r.n) for r in middle.collect()] == [(b, n) for b in (4, 8) for n in (10, 100, 1000)]
    slopes = {r.b: r.exponent for r in scaling_exponent(middle).collect()}
    assert np.allclose([slopes[4], slopes[8]], [1.0, 1.5])
    curves = {r.n: (r.linear, r.quadratic) for r in growth_curves(middle).collect()}
    assert np.allclose(curves[1000], (10 * 100, 10 * 100**2)) and np.allclose(curves[10], (10, 10))


def test_sizes_are_rows_whatever_the_ids(table, clustered):
    ids = [i * 10**12 - 5 * 10**13 for i in range(len(clustered))]
    usual = sorted(tuple(r) for r in sweep(table(clustered), [0, 40, 150], ks=KS).collect())
    assert sorted(tuple(r) for r in sweep(table(clustered, ids), [0, 40, 150], ks=KS).collect()) == usual


def test_large_sizes_stay_whole(spark, tmp_path):
    from bandwise.sources.sinks import read_quality

    rows = [(3 * 10**9, 8, 64, 0, 2, 2**53 + 3, 1.0, 0.0, 1.0)]
    columns = "n long, b int, m int, k int, num_docs long, num_pairs long, mean_cosine double, mean_hamming double, cosine_hamming double"
    write_quality(spark.createDataFrame(rows, columns), str(tmp_path / "large"))
    row = read_quality(spark, str(tmp_path / "large")).first()
    assert (row.n, row.num_pairs) == (3 * 10**9, 2**53 + 3)


def test_tables_are_released_by_any_kind_of_path(spark, tmp_path):
    from bandwise import durable as D

    for path in (str(tmp_path / "bare"), f"file:{tmp_path}/short", f"file://{tmp_path}/long"):
        spark.range(3).write.parquet(path)
        D._written.append(path)
        release([path])
    assert list(tmp_path.iterdir()) == []


def test_a_sweep_writes_no_pairs(table, clustered):
    before = set(written_tables())
    assert sweep(table(clustered), [75, 150], ms=[64], bs=[8, 16], ks=[24]).count() == 4
    labels = {path.rsplit("/", 1)[1].rsplit("-", 1)[0] for path in written_tables() if path not in before}
    assert labels <= {"bandwise-signatures", "bandwise-unit-sums", "bandwise-hot-buckets"}
