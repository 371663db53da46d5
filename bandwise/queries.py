"""Named queries over the ``embeddings`` table, one for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwise.durable import durable, durable_path
from bandwise.functions.simhash import with_norm, with_simhash
from bandwise.operators.banding import BUCKET, band_keys, bucket_sizes
from bandwise.operators.pairs import candidate_count, candidate_pairs, with_cosine, with_own_vectors
from bandwise.plans.quality import quality_by_k, similar_docs_by_k
from bandwise.plans.report import growth_curves, largest_n, representative_k, scaling_exponent
from bandwise.plans.similar import similar_pairs
from bandwise.plans.sweep import sweep
from bandwise.sources.fvecs import read_fvecs, write_fvecs
from bandwise.sources.sinks import read_quality, write_pairs, write_quality
from bandwise.sources.vectors import first_n, read_vectors

M = 64
BS = (4, 8)
KS = (16, 20, 24)
SMALL_KS = (0, 2, 4, 8)
WIDE_M = 128
WIDE_BS = (10, 16)


def rounded(value: Column | str) -> Column:
    """Six decimals, with negative zero folded into zero."""
    return F.round(value, 6) + F.lit(0.0)


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_vectors(spark, f"{sf_dir}/embeddings.parquet", "vec_id", "embedding")


def signatures(spark: SparkSession, sf_dir: str, m: int = M) -> DataFrame:
    return with_simhash(embeddings(spark, sf_dir), m).select("doc_id", "sig")


def with_near_copies(vectors: DataFrame) -> DataFrame:
    """The table, ids doubled, and a copy of each vector with its last element halved under the odd id that follows."""
    copy = F.concat(F.slice("vec", F.lit(1), F.size("vec") - 1), F.array((F.element_at("vec", -1) * 0.5).cast("float")))
    doubled = vectors.withColumn("doc_id", F.col("doc_id") * 2)
    return doubled.unionByName(doubled.select((F.col("doc_id") + 1).alias("doc_id"), copy.alias("vec")))


def table_sizes(vectors: DataFrame) -> list[int]:
    """A quarter, half and all of the rows."""
    n = vectors.count()
    return [n // 4, n // 2, n]


def tidy(quality: DataFrame) -> DataFrame:
    means = ("mean_cosine", "mean_hamming", "cosine_hamming")
    return quality.select(*[rounded(c).alias(c) if c in means else F.col(c) for c in quality.columns])


def vector_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = embeddings(spark, sf_dir)
    return first_n(vectors, table_sizes(vectors)[1]).select(
        "doc_id",
        F.size("vec").alias("dim"),
        F.array_min("vec").cast("double").alias("vec_min"),
        F.array_max("vec").cast("double").alias("vec_max"),
    )


def vector_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_norm(embeddings(spark, sf_dir)).select("doc_id", rounded("norm").alias("norm"))


def simhash_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signatures(spark, sf_dir)


def simhash_signature_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    sig = F.col("sig")
    return signatures(spark, sf_dir, WIDE_M).select("doc_id", sig[0].alias("word0"), sig[1].alias("word1"))


def all_band_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return band_keys(signatures(spark, sf_dir), M, BS).select("doc_id", *BUCKET)


def band_keys_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return band_keys(signatures(spark, sf_dir, WIDE_M), WIDE_M, WIDE_BS).select("doc_id", *BUCKET)


def all_bucket_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bucket_sizes(band_keys(signatures(spark, sf_dir).drop("doc_id"), M, BS))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidate_pairs(signatures(spark, sf_dir), M, BS).select("b", "d1", "d2")


def candidate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidate_count(signatures(spark, sf_dir), M, BS)


def candidate_count_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidate_count(signatures(spark, sf_dir, WIDE_M), WIDE_M, WIDE_BS)


def hamming_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidate_pairs(signatures(spark, sf_dir), M, BS)


def cosine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = embeddings(spark, sf_dir)
    pairs = candidate_pairs(with_own_vectors(with_simhash(vectors, M), vectors), M, BS)
    return with_cosine(pairs, vectors).withColumn("cos", rounded("cos"))


def similar_pairs_up_to(k: int) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return similar_pairs(embeddings(spark, sf_dir), M, BS, k).withColumn("cos", rounded("cos"))

    return query


def similar_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = candidate_pairs(signatures(spark, sf_dir), M, BS, max_h=max(KS))
    return similar_docs_by_k(pairs, KS, M, BS)


def quality(
    ks: tuple[int, ...], m: int = M, bs: tuple[int, ...] = BS
) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        pairs = similar_pairs(embeddings(spark, sf_dir), m, bs, max(ks))
        return tidy(quality_by_k(pairs, ks, m, bs))

    return query


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = similar_pairs(with_near_copies(embeddings(spark, sf_dir)), M, BS, max(SMALL_KS))
    return pairs.withColumn("cos", rounded("cos"))


def near_duplicate_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of the table with its near copies, by groups of equal signatures."""
    vectors = with_near_copies(embeddings(spark, sf_dir))
    grid = sweep(vectors, [vectors.count()], [M], BS, SMALL_KS)
    return tidy(grid.drop("n"))


def swept(
    ms: tuple[int, ...] = (M,),
    bs: tuple[int, ...] = BS,
    ks: tuple[int, ...] = KS,
) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        vectors = embeddings(spark, sf_dir)
        return tidy(sweep(vectors, table_sizes(vectors), ms, bs, ks))

    return query


def sparse_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sweep over ids that are no row positions, half of them negative."""
    vectors = embeddings(spark, sf_dir).withColumn("doc_id", F.col("doc_id") * 1_000_003 - 250_000_000)
    return tidy(sweep(vectors, table_sizes(vectors), [M], BS, KS))


def stored(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The result as a written table, for reports that read it more than once."""
    return lambda spark, sf_dir: durable(query(spark, sf_dir), "report")


def pair_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similar pairs by table size at the middle threshold: a repeatable measure of growth."""
    return representative_k(swept(bs=(8, 16))(spark, sf_dir), KS).select("n", "b", "num_pairs")


def pair_growth_exponent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaling_exponent(pair_growth(spark, sf_dir), "num_pairs").withColumn("exponent", rounded("exponent"))


def pair_growth_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return growth_curves(stored(pair_growth)(spark, sf_dir), "num_pairs").select(
        "n", rounded("linear").alias("linear"), rounded("quadratic").alias("quadratic")
    )


def fvecs_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors written as ``.fvecs`` files and read again."""
    path = durable_path(spark, "fvecs")
    write_fvecs(embeddings(spark, sf_dir), path)
    ends = [F.element_at("vec", k).cast("double").alias(name) for k, name in ((1, "vec_first"), (-1, "vec_last"))]
    total = F.aggregate("vec", F.lit(0.0), lambda done, x: done + x)
    return read_fvecs(spark, path).select("doc_id", F.size("vec").alias("dim"), *ends, rounded(total).alias("vec_sum"))


def quality_table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sweep's quality table, stored by size and read again."""
    path = durable_path(spark, "quality")
    write_quality(swept()(spark, sf_dir), path)
    return read_quality(spark, path).drop("time_sec")


def scored_pairs_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored pairs, stored by band count and read again."""
    return write_pairs(similar_pairs_up_to(16)(spark, sf_dir), durable_path(spark, "pairs"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "vector_prefix": vector_prefix,
        "vector_norm": vector_norm,
        "simhash_signature": simhash_signature,
        "simhash_signature_wide": simhash_signature_wide,
        "band_keys": all_band_keys,
        "band_keys_wide": band_keys_wide,
        "bucket_sizes": all_bucket_sizes,
        "candidate_pairs": candidates,
        "candidate_count": candidate_counts,
        "candidate_count_wide": candidate_count_wide,
        "hamming_pairs": hamming_pairs,
        "cosine_pairs": cosine_pairs,
        "similar_pairs_k16": similar_pairs_up_to(16),
        "similar_pairs_k24": similar_pairs_up_to(24),
        "similar_docs_by_k": similar_docs,
        "quality_by_k": quality(KS),
        "quality_by_k_wide": quality((32, 40, 48), m=WIDE_M, bs=WIDE_BS),
        "quality_by_k_empty": quality((0,)),
        "near_duplicates": near_duplicates,
        "near_duplicate_quality": near_duplicate_quality,
        "sweep_quality": swept(),
        "sweep_sparse_ids": sparse_ids,
        "sweep_signature_bits": swept(ms=(32, 64, 128, 256), bs=(8,), ks=(12, 20, 44)),
        "sweep_largest_n": lambda spark, sf_dir: largest_n(stored(swept())(spark, sf_dir)),
        "sweep_representative_k": lambda spark, sf_dir: representative_k(swept()(spark, sf_dir), KS),
        "scaling_exponent": pair_growth_exponent,
        "growth_curves": pair_growth_curves,
        "fvecs_round_trip": fvecs_round_trip,
        "quality_table_round_trip": quality_table_round_trip,
        "scored_pairs_round_trip": scored_pairs_round_trip,
    }
