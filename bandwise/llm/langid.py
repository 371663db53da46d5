"""Language identification: averaged embeddings of hashed subwords and a linear softmax, trained with numpy."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwise.llm.common import per_process, slices

BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
DIMENSIONS = 16
SAMPLE_PER_LANGUAGE = 1000
EPOCHS = 8
UNDETERMINED = "und"
#: Share of rightly classified calibration documents that rejection may cost.
REJECTED = 0.002
CHUNK_CHARS = 1 << 19
SPACE = 32


def letters() -> np.ndarray:
    """For every code point its lower-case letter, or a space if it is no letter."""

    def build() -> np.ndarray:
        table = np.full(0x110000, SPACE, np.uint32)
        for code in range(0x110000):
            char = chr(code)
            if unicodedata.category(char)[0] == "L":
                low = char.lower()
                table[code] = ord(low[0])
        return table

    return per_process("letters", build)


def subwords(texts: list[str | None], buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Buckets of the subwords of whole texts, the text each belongs to, and how many there are, in pieces of
    about ``CHUNK_CHARS`` code points.

    A subword is 1 to 4 characters inside a lower-cased word with one space on either side. A long text comes in
    several pieces that overlap by three characters.
    """
    table = letters()
    overlap = max(ORDERS) - 1

    def piece(parts: list[np.ndarray], owners: list[int]) -> tuple[np.ndarray, np.ndarray, int]:
        codes = table[np.concatenate(parts)]
        owner = np.repeat(np.array(owners, np.int64), [len(p) for p in parts])
        kept = np.ones(len(codes), bool)
        kept[1:] = (codes[1:] != SPACE) | (codes[:-1] != SPACE) | (owner[1:] != owner[:-1])
        codes, owner = codes[kept], owner[kept]
        space = codes == SPACE
        found, texts_of = [], []
        mixed = np.zeros(len(codes), np.uint32)
        for n in ORDERS:
            if len(codes) < n:
                break
            end = len(codes) - n + 1
            mixed = mixed[:end] * np.uint32(0x9E3779B1) + codes[n - 1 :]  # wraps at 32 bits
            ok = (owner[:end] == owner[n - 1 :]) & ~(space[:end] & space[n - 1 :])
            for k in range(1, n - 1):  # no word ends inside
                ok &= ~space[k : k + end]
            h = mixed[ok]
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77) + np.uint32(n)
            found.append(((h >> np.uint32(8)) % np.uint32(buckets)).astype(np.int64))
            texts_of.append(owner[:end][ok])
        return np.concatenate(found), np.concatenate(texts_of), len(texts)

    parts, owners, size = [], [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        for at in range(0, len(text), CHUNK_CHARS):
            part = text[max(0, at - overlap) : at + CHUNK_CHARS]
            codes = np.frombuffer(f" {part} ".encode("utf-32-le", "surrogatepass"), np.uint32)
            parts.append(codes)
            owners.append(i)
            size += len(codes)
            if size >= CHUNK_CHARS:
                yield piece(parts, owners)
                parts, owners, size = [], [], 0
    if parts:
        yield piece(parts, owners)


@dataclass
class LanguageModel:
    """``scores[bucket, language]``: the embedding of a bucket times the output weights."""

    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """For each text a probability per language, and whether it has a letter."""
        total = np.zeros((len(texts), len(self.languages)))
        count = np.zeros(len(texts))
        columns = np.ascontiguousarray(self.scores.T, np.float64)
        for buckets, owner, n in subwords(texts):
            if not len(owner):
                continue
            # Owners come in runs, so sums over runs do.
            starts = np.concatenate([[0], np.nonzero(owner[1:] != owner[:-1])[0] + 1])
            count += np.bincount(owner[starts], np.diff(starts, append=len(owner)), minlength=n)
            for k, scores in enumerate(columns):
                total[:, k] += np.bincount(owner[starts], np.add.reduceat(scores[buckets], starts), minlength=n)
        logits = (total / np.maximum(count, 1)[:, None] + self.bias) / self.temperature
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        return odds / odds.sum(axis=1, keepdims=True), count > 0


def softmax(logits: np.ndarray) -> np.ndarray:
    odds = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return odds / odds.sum(axis=-1, keepdims=True)


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, languages: list[str], seed: int = 7) -> LanguageModel:
    """Stochastic gradient descent, one document a step, on four fifths; temperature and threshold from the rest.

    ``bags`` has the buckets of each document and their shares of its subwords. The temperature is
    the one of least loss on the rest. The threshold lets at most ``REJECTED`` of the
    rightly classified of the rest go, and is never above one half.
    """
    rng = np.random.default_rng(seed)
    n_lang = len(languages)
    embed = rng.uniform(-0.1, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    out = np.zeros((DIMENSIONS, n_lang), np.float32)
    out += rng.uniform(-0.1, 0.1, out.shape).astype(np.float32)
    bias = np.zeros(n_lang, np.float32)
    order = rng.permutation(len(bags))
    held = order[: len(bags) // 5]
    learn = order[len(bags) // 5 :]
    steps, total = 0, EPOCHS * max(1, len(learn))
    for _ in range(EPOCHS):
        for i in rng.permutation(learn):
            rate = np.float32(0.5 * (1 - steps / total) + 0.01)
            steps += 1
            where, share = bags[i]
            hidden = share @ embed[where]
            error = softmax(hidden @ out + bias)
            error[labels[i]] -= 1
            back = out @ error
            out -= rate * np.outer(hidden, error)
            bias -= rate * error
            # Shares of a long document are tiny; its buckets learn in proportion to them, scaled up alike for all.
            embed[where] -= (rate * 20 * share)[:, None] * back
    model = LanguageModel(languages, embed @ out, bias)
    if len(held) == 0:
        return model
    logits = np.array([bags[i][1] @ model.scores[bags[i][0]] + bias for i in held])
    truth = labels[held]
    grid = np.geomspace(0.02, 20, 61)
    loss = [-np.log(softmax(logits / t)[np.arange(len(held)), truth] + 1e-12).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    odds = softmax(logits / model.temperature)
    right = odds.argmax(axis=1) == truth
    if right.any():
        model.threshold = min(0.5, float(np.quantile(odds.max(axis=1)[right], REJECTED)))
    return model


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from. A null id is in no fold and is held out as well."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel:
    """A model from a sample of the labelled documents that are not held out: of each language
    about ``per_language``, those whose hashed id is below that share of all its documents. Their subword counts,
    at most one for each of ``BUCKETS``, come to the driver. Whole texts are counted. Texts without a letter teach nothing.

    Without any such document the model knows no language.
    """
    spark = docs.sparkSession
    h = F.xxhash64("doc_id", F.lit("langid"))
    labelled = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).withColumn("h", h)
    cuts = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    shares = {r.lang: per_language / r.n for r in cuts.collect()}
    if not shares:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0))
    limits = spark.createDataFrame(
        [(lang, int(-(2**63) + s * 2**64) if s < 1 else 2**63 - 1) for lang, s in shares.items()],
        "lang string, most long",
    )
    sample = labelled.join(F.broadcast(limits), "lang").where("h <= most").select("lang", "text")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            n = batch.num_rows
            keys, counts = [[] for _ in range(n)], [[] for _ in range(n)]
            for buckets, owner, _ in subwords(batch.column(1).to_pylist()):
                both, times = np.unique(owner * BUCKETS + buckets, return_counts=True)
                for i in range(n):
                    mine = both // BUCKETS == i
                    if mine.any():
                        keys[i].append(both[mine] % BUCKETS)
                        counts[i].append(times[mine])
            packed = []
            for k, c in zip(keys, counts):
                where, back = np.unique(np.concatenate(k), return_inverse=True) if k else (np.empty(0, np.int64), None)
                times = np.bincount(back, np.concatenate(c)) if k else np.empty(0)
                packed.append((where.astype("<u4").tobytes(), times.astype("<f4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p[0] for p in packed], pa.binary()), pa.array([p[1] for p in packed], pa.binary())],
                ["lang", "buckets", "counts"],
            )

    rows = sample.mapInArrow(bags, "lang string, buckets binary, counts binary").where("octet_length(buckets) > 0").collect()
    rows.sort(key=lambda r: (r.lang, r.buckets, r.counts))
    languages = sorted({r.lang for r in rows})
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0))
    number = {lang: i for i, lang in enumerate(languages)}
    made = []
    for r in rows:
        times = np.frombuffer(r.counts, "<f4")
        made.append((np.frombuffer(r.buckets, "<u4").astype(np.int64), (times / times.sum()).astype(np.float32)))
    return train(made, np.array([number[r.lang] for r in rows]), languages)


def with_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``accepted``, from nothing but the whole text.

    A text that is null or has no letter is ``und`` with score 0 and not accepted, and so is every text
    if the model knows no language. Others get the most probable language; they are accepted from the
    model's threshold on. All rows and columns stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double, accepted: boolean>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        for batch in batches:
            names, scores = [], []
            for at in range(0, len(batch), 128):
                texts = batch.slice(at, 128).to_pylist()
                if not known.languages:
                    names += [UNDETERMINED] * len(texts)
                    scores += [0.0] * len(texts)
                    continue
                odds, lettered = known.probabilities(texts)
                best = odds.argmax(axis=1)
                names += [known.languages[k] if ok else UNDETERMINED for k, ok in zip(best, lettered)]
                scores += np.where(lettered, odds.max(axis=1), 0.0).tolist()
            accepted = [n != UNDETERMINED and s >= known.threshold for n, s in zip(names, scores)]
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())],
                ["lang_pred", "score", "accepted"],
            )

    found = docs.withColumn("found", predict("text"))
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "accepted")]
    return found.select(*kept, "found.lang_pred", "found.score", "found.accepted")
