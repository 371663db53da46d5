"""Sinks for quality tables and scored pairs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUALITY_SCHEMA = (
    "b int, m int, k int, num_docs long, time_sec double, mean_cosine double, cosine_hamming double, "
    "num_pairs long, mean_hamming double, n long"
)


def _columns() -> list[str]:
    return [field.strip().split()[0] for field in QUALITY_SCHEMA.split(",")]


def write_quality(quality: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write the rows of one or more sizes to their ``n=`` folders, replacing those folders only.

    A repeated write of a size is therefore harmless. CSV files carry a header.
    """
    rows = quality if "time_sec" in quality.columns else quality.withColumn("time_sec", F.lit(None).cast("double"))
    schema = dict(field.strip().split() for field in QUALITY_SCHEMA.split(","))
    writer = rows.select(*[F.col(c).cast(schema[c]) for c in _columns()]).write.mode("overwrite").partitionBy("n")
    writer = writer.option("partitionOverwriteMode", "dynamic")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)


def read_quality(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The whole quality table."""
    reader = spark.read.schema(QUALITY_SCHEMA).format(fmt)
    rows = (reader.option("header", True) if fmt == "csv" else reader).load(path)
    first = ["n", "b", "m", "k", "num_docs", "time_sec", "mean_cosine", "cosine_hamming"]
    return rows.select(*first, *[c for c in _columns() if c not in first])


def finished_sizes(spark: SparkSession, path: str, fmt: str = "parquet") -> set[int]:
    """Sizes already in the table at ``path``; empty when there is no table."""
    try:
        rows = read_quality(spark, path, fmt)
        return {row.n for row in rows.select("n").distinct().collect()}
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return set()
        raise


def write_pairs(pairs: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write scored pairs as parquet, one folder per band count, and return the written table."""
    pairs.write.mode(mode).partitionBy("b").parquet(path)
    return pairs.sparkSession.read.schema(pairs.schema).parquet(path).select(*pairs.columns)
