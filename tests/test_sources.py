import numpy as np
import pytest
from pyspark.sql import functions as F

from bandwise.sources.fvecs import PUSHDOWN, read_fvecs
from bandwise.sources.fvecs import write_fvecs as write_vectors
from bandwise.sources.vectors import first_n, prefix_cutoff, read_vectors


def write_fvecs(path, matrix):
    matrix = np.asarray(matrix, dtype="<f4")
    records = np.empty((len(matrix), matrix.shape[1] + 1), dtype="<i4")
    records[:, 0] = matrix.shape[1]
    records[:, 1:] = matrix.view("<i4")
    records.tofile(path)


@pytest.mark.parametrize("rows,dim,split", [(1, 4, 64), (1000, 4, 100), (777, 128, 10_000), (50, 64, 1 << 26)])
def test_fvecs_round_trip(spark, tmp_path, rows, dim, split):
    matrix = np.random.default_rng(0).standard_normal((rows, dim)).astype("f4")
    write_fvecs(tmp_path / "v.fvecs", matrix)
    df = read_fvecs(spark, str(tmp_path / "v.fvecs"), partition_bytes=split)
    assert df.schema.simpleString() == "struct<doc_id:bigint,vec:array<float>>"
    got = df.orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == list(range(rows))
    assert np.array_equal(np.array([r.vec for r in got], dtype="f4"), matrix)
    assert df.rdd.getNumPartitions() == -(-rows // max(1, split // (4 * (dim + 1))))


def test_fvecs_folder_numbers_records_over_files(spark, tmp_path):
    matrix = np.arange(40, dtype="f4").reshape(10, 4)
    for name, part in (("b", matrix[6:]), ("a", matrix[:6])):
        write_fvecs(tmp_path / f"{name}.fvecs", part)
    (tmp_path / "_SUCCESS").touch()
    (tmp_path / "c.fvecs").touch()
    got = read_fvecs(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert np.array_equal(np.array([r.vec for r in got]), matrix)
    assert read_fvecs(spark, str(tmp_path), rows=7).count() == 7
    assert read_fvecs(spark, f"file://{tmp_path}").count() == 10


def test_fvecs_faults(spark, tmp_path):
    write_fvecs(tmp_path / "cut.fvecs", np.ones((3, 4)))
    with open(tmp_path / "cut.fvecs", "ab") as f:
        f.write(b"\0\0\0\0")
    with pytest.raises(Exception, match="not a multiple"):
        read_fvecs(spark, str(tmp_path / "cut.fvecs")).count()
    records = np.array([[2, 0, 0], [9, 0, 0]], dtype="<i4")
    records.tofile(tmp_path / "mixed.fvecs")
    with pytest.raises(Exception, match="differ in length"):
        read_fvecs(spark, str(tmp_path / "mixed.fvecs")).collect()
    (tmp_path / "empty.fvecs").touch()
    assert read_fvecs(spark, str(tmp_path / "empty.fvecs")).count() == 0


def test_prefix_filter_reaches_the_reader(spark, tmp_path):
    write_fvecs(tmp_path / "v.fvecs", np.ones((1000, 4)))
    spark.conf.set(PUSHDOWN, "true")
    try:
        df = read_fvecs(spark, str(tmp_path / "v.fvecs"), partition_bytes=2000)
        few = first_n(df, 150)
        assert df.rdd.getNumPartitions() == 10 and few.rdd.getNumPartitions() == 2
        assert few.count() == 150
        assert [r.doc_id for r in df.where("doc_id = 42").collect()] == [42]
        assert df.where("doc_id <= 42 and doc_id > 40").count() == 2
    finally:
        spark.conf.unset(PUSHDOWN)



def test_parquet_vectors(spark):
    df = read_vectors(spark, "/root/testdata/sf0.001/embeddings.parquet", "vec_id", "embedding")
    few = first_n(df, 100)
    assert few.count() == 100 and first_n(df, 0).count() == 0
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(vec_id,100)" in plan and "label" not in plan


@pytest.mark.parametrize("spread", [1, 10**3, 10**12])
def test_first_n_of_sparse_ids(spark, spread):
    ids = np.unique(np.random.default_rng(2).integers(-spread, 5000 * spread, 3000))
    df = spark.createDataFrame([(int(i), [1.0]) for i in ids], "doc_id long, vec array<float>")
    for n in (1, 2, 500, len(ids) - 1, len(ids), len(ids) + 5):
        got = sorted(r.doc_id for r in first_n(df, n, dense=False).select("doc_id").collect())
        assert got == sorted(int(i) for i in ids)[:n]
    assert prefix_cutoff(df, len(ids)) is None


def test_cutoff_over_the_whole_range_of_ids(spark):
    low, high = -(2**63), 2**63 - 1
    df = spark.createDataFrame([(low,), (0,), (high,)], "doc_id long").withColumn("vec", F.array(F.lit(1.0)))
    assert [prefix_cutoff(df, n) for n in (1, 2, 3)] == [low, 0, None]


def test_written_vectors_are_read_in_the_order_of_their_ids(spark, tmp_path):
    rows = [(int(i), [float(i), 0.5 * float(i)]) for i in np.random.default_rng(1).permutation(500) - 200]
    vectors = spark.createDataFrame(rows, "doc_id long, vec array<double>").repartition(7)
    path = f"file:{tmp_path}/out"
    write_vectors(vectors, path)
    got = read_fvecs(spark, path).orderBy("doc_id").collect()
    assert [(r.doc_id, r.vec) for r in got] == [(k, vec) for k, (_, vec) in enumerate(sorted(rows))]
    assert sorted(p.name[:4] for p in (tmp_path / "out").iterdir() if p.suffix != ".crc")[0] == "part"
    with pytest.raises(FileExistsError):
        write_vectors(vectors, path)


def test_vectors_of_different_lengths_are_not_written(spark, tmp_path):
    for k, odd in enumerate(([1.0], None, [1.0, None], [])):
        vectors = spark.createDataFrame([(0, [1.0, 2.0]), (1, odd)], "doc_id long, vec array<float>")
        with pytest.raises(Exception, match="equally long"):
            write_vectors(vectors, str(tmp_path / f"out{k}"))
