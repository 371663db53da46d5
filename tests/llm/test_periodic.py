import hashlib
import re
import time
import zlib

import numpy as np
import pytest
from odd import ODD
from pyspark.sql import functions as F

from bandwise.llm import periodic
from bandwise.llm.queries import op13_periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    """Every maximal stretch for every period, the least period per stretch, then the length rule."""
    n, least = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            x = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            key = (x, i + q)
            least[key] = min(least.get(key, q), q)
    found = [(s, e - s, q) for (s, e), q in least.items() if e - s >= max(12, 2 * q)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = set()
    for s, length, q in runs:
        gone.update(range(s + q, s + length))
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def brute_planted(doc_id, text):
    words = WORD.findall(text or "")
    if doc_id is None:
        return text
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words))


def sequences():
    rng = np.random.default_rng(3)
    out = [list("ab" * 20), list("a" * 30), list("abcabcabcabcabcx"), list("abcdefghijkl" * 2 + "abcdefghijk")]
    for size, alphabet in [(40, 2), (60, 3), (200, 2), (300, 4), (150, 1)]:
        for _ in range(6):
            out.append([chr(97 + x) for x in rng.integers(0, alphabet, size)])
    # Planted periods inside noise, and a run of a run.
    for _ in range(8):
        unit = [f"w{x}" for x in rng.integers(0, 50, rng.integers(1, 20))]
        noise = [f"n{x}" for x in rng.integers(0, 5, 30)]
        out.append(noise + unit * int(rng.integers(2, 6)) + unit[: int(rng.integers(0, len(unit) + 1))] + noise)
    return out


def test_runs_match_brute_force():
    for words in [*sequences(), list("abcdefghijklmnop")]:
        ids = np.unique(np.array(words, dtype=object), return_inverse=True)[1]
        assert [tuple(r) for r in periodic.runs_of(ids)] == brute_runs(words), words


def test_operator_rows(spark, docs):
    texts = [" ".join(w) for w in sequences()[:12]] + ODD + ["x " * 5000]
    found = periodic.periodic_runs(docs(texts).withColumn("runs", F.lit(1)).withColumn("collapsed", F.lit(2)))
    rows = sorted(found.collect(), key=lambda r: r.doc_id)
    assert len(rows) == len(texts) and "fingerprints" in found.columns
    for row, text in zip(rows, texts):
        words = WORD.findall(text or "")
        runs = brute_runs(words) if len(words) < 1000 else [(0, 5000, 1)]
        assert row.n_words == len(words)
        assert [(r.start, r.length, r.period) for r in row.runs] == runs
        assert row.collapsed == brute_collapsed(words, runs)


def test_planted_period(spark, docs):
    texts = [" ".join(f"w{j}" for j in range(k * 7 % 40)) for k in range(120)] + ODD
    ids = list(range(len(texts)))
    got = docs(texts, ids=ids).select("doc_id", periodic.planted(F.col("doc_id"), F.col("text")).alias("t")).collect()
    assert {r.doc_id: r.t for r in got} == {i: brute_planted(i, t) for i, t in zip(ids, texts)}


def test_query_columns(spark, tmp_path):
    texts = ["a b " * 10, None, "", "no run here at all"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op13_periodic(spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        words = WORD.findall(brute_planted(i, text) or "")
        runs = brute_runs(words)
        row = got[i]
        assert row.n_runs == len(runs)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{ln},{q}\n" for s, ln, q in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest()
        if runs:
            s, ln, q = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[0]
            assert (row.start, row.length, row.period, row.exponent_milli) == (s, ln, q, 1000 * ln // q)
        else:
            assert (row.start, row.length, row.period, row.exponent_milli) == (None,) * 4


def test_long_texts_plant_and_scan_in_linear_time(spark, docs):
    # Before, the planted words split the whole text once for each word: minutes for these.
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:12]
    texts = [" ".join(f"w{j * 7919 % 20011}" for j in range(20_000)) for _ in ids]
    begun = time.monotonic()
    got = docs(texts, ids=ids).select("doc_id", periodic.planted(F.col("doc_id"), F.col("text")).alias("t")).collect()
    assert {r.doc_id: r.t for r in got} == {i: brute_planted(i, t) for i, t in zip(ids, texts)}
    assert time.monotonic() - begun < 30


def test_words_part_only_at_six_characters():
    text = "a\x1cb\u00a0c\x85d e\tf\ng\x0bh\x0ci\rj"
    assert periodic.find_runs(text) == (7, [], " ".join(WORD.findall(text)))
    unit = "x\u2003y z"
    assert periodic.find_runs(f"{unit} " * 6) == (12, [{"start": 0, "length": 12, "period": 2}], unit)


def test_texts_without_a_recurring_block_are_not_named(monkeypatch):
    words = [f"w{j}" for j in range(500)]
    monkeypatch.setattr(periodic, "_names", lambda ids: pytest.fail("named"))
    assert periodic.find_runs(" ".join(words)) == (500, [], " ".join(words))
