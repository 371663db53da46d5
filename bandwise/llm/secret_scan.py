"""Secrets in texts, and how many owners share each: all by built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwise.durable import durable
from bandwise.llm.common import let, scan

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# Runs that are too short fall away, so the length may as well be part of these two patterns.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}+"
#: Long tokens of letters and digits, candidates without any keyword.
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
ASSIGNED = 12
#: A value of at least so many owners is a widely copied example.
COPIED_OWNERS = 3
#: So is one in at least so many repositories, whoever owns them.
COPIED_REPOSITORIES = 20
#: What a live credential has at least: different characters.
LIVE_CHARACTERS = 10
KINDS = ("assign", "access", "hex", "owned")
SPAN = "array<struct<start: int, kind: int, end: int, value: bigint>>"
MASK = "[SECRET]"


def spans(text: Column, pattern: str, kind: int, value_group: int = 0, passes=None) -> Column:
    """All leftmost non-overlapping matches in ``text`` as ``start, kind, end, value`` in code points, end exclusive.

    What lies between the matches tells their places. ``value`` is a hash of the given group,
    and ``passes`` a condition on that group's text.
    """
    found = F.struct(
        F.split(text, pattern, -1).alias("between"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("value"),
    )

    def placed(found: Column) -> Column:
        lengths = F.zip_with(
            F.slice(found["between"], F.lit(1), F.size(found["match"])),
            found["match"],
            lambda between, match: (F.char_length(between) + F.char_length(match)).cast("bigint"),
        )
        ends = scan(lengths, F.lit(0).cast("bigint"), lambda done, x: done + x)
        rows = F.zip_with(
            F.arrays_zip(found["match"].alias("match"), found["value"].alias("value")),
            ends,
            lambda row, end: F.struct(
                (end - F.char_length(row["match"])).cast("int").alias("start"),
                F.lit(kind).alias("kind"),
                end.cast("int").alias("end"),
                row["value"].alias("value"),
            ),
        )
        rows = F.filter(rows, lambda row: passes(row["value"])) if passes else rows
        return F.transform(
            rows, lambda row: F.struct(row["start"], row["kind"], row["end"], F.xxhash64(row["value"]).alias("value"))
        )

    return let(found, placed).cast(SPAN)


def live_looking(value: Column) -> Column:
    """A token with both a digit and a letter and enough different characters."""
    characters = F.size(F.array_distinct(F.split(value, "")))
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (characters >= LIVE_CHARACTERS)


def joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ","
    )


def count_of(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def candidates(docs: DataFrame, key: list[str], owner: str) -> DataFrame:
    """``key``, ``owner``, ``base`` spans and ``extra`` spans (long tokens outside all base spans) of every document."""
    text = F.coalesce("text", F.lit(""))
    none = F.array().cast(SPAN)
    low = F.lower(text)
    keyword = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api")
    base = F.concat(
        F.when(keyword, spans(text, ASSIGN, 0, 2, lambda value: F.char_length(value) >= ASSIGNED)).otherwise(none),
        F.when(text.contains("AKIA"), spans(text, ACCESS, 1)).otherwise(none),
        F.when(text.rlike(HEX), spans(text, HEX, 2)).otherwise(none),
    )
    extra = F.when(text.rlike(TOKEN), spans(text, TOKEN, 3, 0, live_looking)).otherwise(none)
    found = docs.select(*key, F.col(owner).alias("owner"), base.alias("base"), extra.alias("extra"))
    apart = F.filter(
        "extra", lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
    )
    return found.select(*key, "owner", "base", F.when(F.size("extra") > 0, apart).otherwise(none).alias("extra"))


def ownership(found: DataFrame) -> DataFrame:
    """``value, owners, repositories`` of every candidate value: its distinct owners and distinct documents.

    Counted in two steps, each combined before its shuffle, so a value that is everywhere costs a
    task a row per owner. Null owners count as one owner.
    """
    values = F.array_distinct(F.transform(F.concat("base", "extra"), lambda s: s["value"]))
    # Rows that repeat an id and a text are the same document.
    key = [c for c in found.columns if c not in ("owner", "base", "extra")]
    owner = F.coalesce(F.col("owner").cast("string"), F.lit("")).alias("owner")
    rows = found.select(*key, owner, F.explode(values).alias("value")).distinct()
    by_owner = rows.groupBy("value", "owner").agg(F.count("*").alias("repositories"))
    return by_owner.groupBy("value").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))


def secret_spans(docs: DataFrame, owner: str = "source", id: str = "doc_id") -> DataFrame:
    """``id``, ``text_key``, ``base``, ``added``, ``n_copied`` of every document.

    ``base`` spans are kept whoever else has the value. A long token outside them is added if it looks
    live and has fewer than ``COPIED_OWNERS`` owners and ``COPIED_REPOSITORIES`` repositories over the whole corpus; ``n_copied`` counts the spans,
    added or base, whose value is a widely copied example. A document stands for a repository. Null and
    empty texts have no spans; null ids and owners keep their rows; rows that repeat an id and a text
    are the same document and get equal results.
    """
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    key = [id, "text_key"]
    found = durable(candidates(docs, key, owner), "secrets")
    all_spans = F.explode(F.concat("base", "extra")).alias("span")
    spread = found.select(*key, all_spans).select(*key, "span", F.col("span.value").alias("value"))
    known = spread.join(ownership(found), "value")
    copied = (F.col("owners") >= COPIED_OWNERS) | (F.col("repositories") >= COPIED_REPOSITORIES)
    added = known.groupBy(*key).agg(
        F.collect_set(F.when((F.col("span.kind") == 3) & ~copied, F.col("span"))).alias("added"),
        F.size(F.collect_set(F.when(copied, F.col("span")))).alias("n_copied"),
    )
    added = added.toDF("id_of", "key_of", "added", "n_copied")
    same = F.col(id).eqNullSafe(F.col("id_of")) & F.col("text_key").eqNullSafe(F.col("key_of"))
    return found.join(added, same, "left").select(
        *key, "base", F.coalesce("added", F.array().cast(SPAN)).alias("added"), F.coalesce("n_copied", F.lit(0)).alias("n_copied")
    )


def masked(docs: DataFrame, owner: str = "source") -> DataFrame:
    """``docs`` with every span of its texts, base or added, replaced by ``MASK``; overlapping spans become one.

    ``n_chars`` follows if there is one. All rows stay.
    """
    found = secret_spans(docs.select("doc_id", "text", owner), owner)
    # Equal rows of a table have equal spans, and must not multiply.
    found = found.where(F.size("base") + F.size("added") > 0).dropDuplicates(["doc_id", "text_key"])
    found = found.select(
        F.col("doc_id").alias("id_of"), F.col("text_key").alias("key_of"), F.array_sort(F.concat("base", "added")).alias("spans")
    )
    same = F.col("doc_id").eqNullSafe(F.col("id_of")) & F.xxhash64("text").eqNullSafe(F.col("key_of"))
    empty = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    rebuilt = F.aggregate(
        "spans",
        empty,
        lambda acc, s: F.struct(
            F.when(
                s["start"] >= acc["at"],
                F.concat(acc["done"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit(MASK)),
            )
            .otherwise(acc["done"])
            .alias("done"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        ),
        lambda acc: F.concat(acc["done"], F.substring(F.col("text"), acc["at"] + 1, F.char_length("text"))),
    )
    text = F.when(F.col("spans").isNotNull(), rebuilt).otherwise(F.col("text"))
    out = docs.join(found, same, "left").withColumn("text", text).drop("id_of", "key_of", "spans")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
