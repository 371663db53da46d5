"""Document fingerprints by one-permutation MinHash, all by built-in functions.

Every shingle is hashed once; its top bits choose a bin, and each bin keeps its smallest hash. An empty
bin borrows from a bin that has one, found by a walk over the bins that is fixed for this empty
bin (optimal densification). Of each bin the low-order bits are packed into longs; the chance that
low bits agree by accident is taken out of the likeness.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandwise.llm.common import let

BINS = 256
BITS = 4
SHINGLE = 5
PROBES = 6
LONGS = BINS * BITS // 64
RANGE_ROWS = 4096
MOST_RANGES = 8192

_draw = random.Random(20)
#: The walk of bin i visits (STEP[i] * t + START[i]) mod BINS for t = 0, 1, ...: every bin once, as steps are odd.
STEP = [2 * _draw.randrange(BINS // 2) + 1 for _ in range(BINS)]
START = [_draw.randrange(BINS) for _ in range(BINS)]
BACK = [pow(step, -1, BINS) for step in STEP]


def constants(values: list[int], kind: str) -> Column:
    return F.array(*[F.lit(x) for x in values]).cast(f"array<{kind}>")


def shingle_hashes(text: Column) -> Column:
    """A hash for each run of five lower-cased words; with fewer words one for all of them, without words none."""

    def of(words: Column) -> Column:
        n = F.size(words)
        starts = F.sequence(F.lit(1), F.greatest(n - (SHINGLE - 1), F.lit(1)))
        hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, F.lit(SHINGLE))))
        return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(hashes)

    spaced = F.translate(F.lower(text), "\t\r\n\f\u000b", "     ")
    return let(F.array_remove(F.split(spaced, " "), ""), of)


def bin_minima(hashes: Column) -> Column:
    """For each bin the smallest hash in it, or its last possible value if it is empty.

    That value is put into every bin first; after sorting, each bin's first is what is asked for.
    """
    shift = 64 - BINS.bit_length() + 1
    ends = constants([(b << shift) | ((1 << shift) - 1) for b in range(-BINS // 2, BINS // 2)], "bigint")
    return let(
        F.sort_array(F.concat(hashes, ends)),
        lambda every: F.filter(
            every, lambda h, i: (i == 0) | (F.shiftright(h, shift) != F.shiftright(every[F.greatest(i - 1, F.lit(0))], shift))
        ),
    )


def filled_bins(minima: Column) -> Column:
    """The low-order bits of each bin, or of a hash of the borrowed minimum and the empty bin; null without shingles.

    A few steps of the walk are taken for each empty bin; if they hit only empty ones, the full bin that
    comes first on the walk is found from the list of full bins. Both give the same bin. Hashing anew lets
    bins that borrow from one bin agree or differ on their own.
    """
    shift = 64 - BINS.bit_length() + 1
    unfilled = F.lit((1 << shift) - 1).cast("bigint")
    bits = F.lit((1 << BITS) - 1).cast("bigint")
    own = F.transform(minima, lambda h: F.when(h.bitwiseAND(unfilled) != unfilled, h))
    step, start, back = (constants(x, "int") for x in (STEP, START, BACK))
    walks = [constants([(STEP[i] * t + START[i]) % BINS for i in range(BINS)], "int") for t in range(PROBES)]

    def borrowed(own: Column) -> Column:
        full = F.filter(F.transform(own, lambda h, i: F.when(h.isNotNull(), i)), lambda i: i.isNotNull())

        def fill(full: Column) -> Column:
            def searched(i: Column) -> Column:
                first = F.array_min(F.transform(full, lambda j: ((j - start[i] + BINS) * back[i]) % BINS))
                return own[(step[i] * first + start[i]) % BINS]

            def bin_bits(h: Column, i: Column) -> Column:
                donor = F.coalesce(*[own[walk[i]] for walk in walks], searched(i))
                return F.when(h.isNotNull(), h.bitwiseAND(bits)).otherwise(F.xxhash64(donor, i).bitwiseAND(bits))

            return F.when(F.size(full) > 0, F.transform(own, bin_bits))

        return let(full, fill)

    return let(own, borrowed)


def fingerprint(text: Column) -> Column:
    """``LONGS`` packed longs; null if the text has no word."""

    def packed(bins: Column) -> Column:
        each = 64 // BITS
        longs = [
            F.aggregate(
                F.slice(bins, k * each + 1, each), F.lit(0).cast("bigint"), lambda done, v: F.shiftleft(done, BITS).bitwiseOR(v)
            )
            for k in range(LONGS)
        ]
        return F.when(bins.isNotNull(), F.array(*longs))

    return let(filled_bins(bin_minima(shingle_hashes(F.coalesce(text, F.lit(""))))), packed)


def likeness(one: str, two: str) -> Column:
    """Estimated Jaccard likeness of the shingle sets of two fingerprint columns, 0 to 1.

    The share m of agreeing bins counts accidents of probability 2**-BITS; (m - 2**-BITS) / (1 - 2**-BITS)
    does not. Two texts without words are alike, one without and one with words are not.
    """
    lowest = int("1" * (64 // BITS), 1 << BITS)
    apart = F.lit(0)
    for k in range(LONGS):
        x = F.col(one)[k].bitwiseXOR(F.col(two)[k])
        for shift in (1, 2)[: BITS.bit_length() - 1]:
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        apart = apart + F.bit_count(x.bitwiseAND(F.lit(lowest)))
    chance = 2.0**-BITS
    estimate = ((F.lit(BINS) - apart) / F.lit(float(BINS)) - chance) / (1 - chance)
    neither = F.col(one).isNull() & F.col(two).isNull()
    either = F.col(one).isNull() | F.col(two).isNull()
    return F.when(neither, 1.0).when(either, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), estimate)))


def readable(prints: str) -> Column:
    """Fingerprint as hex digits, one for each four bits; empty if the text has no word."""
    digits = F.transform(prints, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0"))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def with_next(docs: DataFrame, carried: list[str], id: str = "doc_id") -> DataFrame:
    """``docs`` with ``next_<c>`` of the carried columns of the next row, by descending ``id``; after the last comes the first.

    Rows are dealt once, into ranges of ids cut at counted quantiles, about ``RANGE_ROWS`` rows each and
    at most ``MOST_RANGES``; only the first row of each range is also sent to the range before it.
    Null ids come last, equal ids in the order of the carried columns. A single row is its own next.
    """
    n = docs.count()
    ranges = max(1, min(MOST_RANGES, n // RANGE_ROWS))
    cuts = []
    if ranges > 1:
        shares = [k / ranges for k in range(1, ranges)]
        found = docs.agg(F.percentile_approx(id, shares, max(10_000, 20 * ranges)).alias("cuts")).first().cuts
        cuts = sorted({int(c) for c in found or []}, reverse=True)
    # Range 0 has the greatest ids.
    spot = F.array_size(F.filter(constants(cuts, "bigint"), lambda c: F.col(id) <= c)) if cuts else F.lit(0)
    spot = F.when(F.col(id).isNull(), len(cuts)).otherwise(spot).cast("int")
    order = [F.col(id).desc_nulls_last(), *[F.col(c) for c in carried]]
    placed = docs.withColumn("range", spot)
    heads = [r for r in placed.groupBy("range").agg(F.max(id).alias("head")).collect()]
    heads.sort(key=lambda r: r["range"])
    before = {heads[k]["range"]: heads[k - 1]["range"] for k in range(len(heads))}
    spark = docs.sparkSession
    lead = spark.createDataFrame(
        [(r["range"], r["head"], before[r["range"]]) for r in heads], "range int, head long, before int"
    ).withColumnRenamed("range", "range_of")
    joined = placed.join(
        F.broadcast(lead), (F.col("range") == F.col("range_of")) & F.col(id).eqNullSafe(F.col("head")), "left"
    )
    guests = F.array(F.struct(F.col("range"), F.lit(False).alias("guest")), F.struct(F.col("before").alias("range"), F.lit(True).alias("guest")))
    own = F.array(F.struct(F.col("range"), F.lit(False).alias("guest")))
    dealt = joined.select(*docs.columns, F.explode(F.when(F.col("range_of").isNotNull(), guests).otherwise(own)).alias("to"))
    dealt = dealt.select(*docs.columns, "to.range", "to.guest")
    window = Window.partitionBy("range").orderBy("guest", *order)
    after = [F.lead(c).over(window).alias(f"next_{c}") for c in carried]
    return dealt.select(*docs.columns, "guest", *after).where(~F.col("guest")).drop("guest")


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Every document with its fingerprint, its edited text and that text's fingerprint, and both likenesses.

    The edit puts the beginning of the next document, by descending ``doc_id``, in place of the last third of
    the code points. Null texts count as empty; rows that share an id follow each other by text.
    """
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    printed = whole.select("doc_id", "text", fingerprint(F.col("text")).alias("print"))
    nexts = with_next(printed, ["text", "print"])
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third))
    rows = nexts.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "print", "next_print")
    return rows.withColumn("edited_print", fingerprint(F.col("edited")))
