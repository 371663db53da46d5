"""One query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from bandwise.durable import durable
from bandwise.llm import bpe, chaining, embed_dedup, html_text, langid, line_dedup, merkle, minhash, packing, periodic, secret_scan, simhash_dedup, suffix_dedup
from bandwise.llm.common import documents

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.edited_pairs(documents(spark, sf_dir)).select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        minhash.readable("print").alias("fingerprint"),
        minhash.readable("edited_print").alias("edited_fingerprint"),
        minhash.likeness("print", "edited_print").alias("near_edited"),
        minhash.likeness("print", "next_print").alias("near_next"),
    )


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = embed_dedup.near_vectors(vectors.select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("vec")))
    return found.withColumnRenamed("id", "vec_id")


def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.repeated_passages(documents(spark, sf_dir))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_spans(documents(spark, sf_dir).select("doc_id", "text", "source"))
    counts = [secret_scan.count_of("base", k).alias(f"n_{secret_scan.KINDS[k]}") for k in range(3)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secret_scan.joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secret_scan.joined(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_owned"),
        F.col("n_copied").cast("long").alias("n_copied"),
    )


def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(documents(spark, sf_dir)).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    found = langid.with_language(docs.select("doc_id", "text"), langid.fit(docs))
    held = langid.held_out(F.col("doc_id")).alias("held_out")
    return found.select("doc_id", held, "lang_pred", "score", "accepted")


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    lost = line_dedup.dropped_lines(docs, all_edits=True)
    lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines")
    every = docs.select("doc_id", F.hash("text").alias("text_key"), lines)
    same = F.col("doc_id").eqNullSafe(F.col("doc")) & F.col("text_key").eqNullSafe(F.col("key"))
    return every.join(lost, same, "left").select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(F.array_join("lines", ","), F.lit("")).alias("dropped"),
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = packing.pieces(documents(spark, sf_dir), TOKENIZER, RANKS, public_tokenizers.PATTERN, with_ids=False)
    return packing.packed(durable(parts, "pieces"))


def tampered_text(docs: DataFrame) -> Column:
    """The text with A-Z lower-cased where 3 divides the unsigned CRC-32 of the decimal ``doc_id``; else as it is."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    chosen = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0
    return F.when(chosen, F.translate("text", upper, lower)).otherwise(F.col("text"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = merkle.manifest(docs, tampered_text(docs))
    steps = F.transform("proof", lambda s: F.concat(s["left"], s["right"]))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(steps, ""), 256).alias("proof_sha256"), "folded_root", "verified"
    )


def op12_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return html_text.main_text(pages).select("page_id", "url", "text", "n_chars")


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    edited = docs.select("doc_id", periodic.planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic.periodic_runs(edited)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-best["start"]).alias("start"),
        best["length"].alias("length"),
        (-best["period"]).alias("period"),
        F.floor(best["length"] * 1000 / -best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit(""))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [op1_bpe, op2_minhash, op3_embeddings, op4_passages, op5_secrets, op6_suffixes, op7_langid, op8_lines, op9_simhash, op10_packing, op11_merkle, op12_html, op13_periodic, pipeline]
    return {query.__name__: query for query in named}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
