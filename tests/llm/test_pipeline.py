import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline


def test_stages(spark, tmp_path):
    words = ["the", "and", "der", "und", "les", "des"]
    rows = []
    for i in range(90):
        lang = ("en", "de", "fr")[i % 3]
        pair = words[2 * (i % 3) : 2 * (i % 3) + 2]
        rows.append((i, "\n".join(" ".join(f"{pair[k % 2]}{pair[(k + i) % 2]}{i}x{n}" for k in range(9)) for n in range(3)), lang, "s", 0))
    rows += [(100, None, None, "s", 0), (101, "", "en", None, 0), (102, "1 2 3", None, "s", 0), (None, rows[5][1], "fr", "s", 0)]
    rows += [(103, rows[4][1].replace("x0", "x0 token = 0123456789abcdef"), "de", "s", 0)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == table.columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    ids = {r.doc_id for r in docs.collect()}
    assert not ids & {100, 101, 102} and len(ids) > 60
    assert not any("0123456789abcdef" in r.text for r in docs.collect())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert {r.doc_id for r in last.collect()} == ids
    table.where("false").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_edited_documents_go(docs, spark):
    rng = random.Random(7)
    texts = []
    for n in (6, 40, 60, 90, 300, 300):
        base = [f"w{rng.randrange(5000)}" for _ in range(n)]
        for edits in (0, 1, 2, n // 60, n // 45, n // 20):
            line = list(base)
            for at in rng.sample(range(n), edits):
                line[at] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(line))
    texts += [None, "", " ", texts[3], "one two", "two one", "one two"]
    rng.shuffle(texts)
    sets = []
    for text in texts:
        words = (text or "").split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    near = [[a == b or bool(a | b) and 5 * len(a & b) >= 4 * len(a | b) for b in sets] for a in sets]
    group = list(range(len(texts)))
    for _ in texts:
        group = [min(group[j] for j in range(len(texts)) if near[i][j]) for i in range(len(texts))]
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    table = docs(texts)
    got = stage(spark, table, "")
    assert got.columns == table.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(set(group)) and len(set(group)) < len(set(texts)) - 5


def test_sequences_hold_the_ids(docs, spark):
    texts = [None, "one two", "one two", "two one", "ß " * 5000, *(f"word {i} " * i for i in range(40))]
    ids = [None, 1, 1, 1, None, *range(10, 50)]
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        encode = Tokenizer.from_str(file.read()).encode
    rows = corpus_pipeline.STAGES[-1][1](spark, docs(texts, ids), "").collect()
    filled = {}
    for r in rows:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert filled.setdefault(r.sequence_id, {}).setdefault(r.offset, r.ids) is r.ids
    for held in filled.values():
        at = 0
        for offset in sorted(held):
            assert offset == at
            at += len(held[offset])
        assert at <= 2048
    expected = [[*encode(t or "", add_special_tokens=False).ids, 0] for t in texts]
    assert sorted(r.ids for r in rows if r.doc_id and r.doc_id != 1) == sorted(expected[5:])
    assert sorted(x for r in rows for x in r.ids) == sorted(x for e in expected for x in e)


def test_every_operator_is_registered():
    names = [n for n in entry_points.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry_points.queries()


def test_fingerprints_meet_in_the_near_duplicate_stage(docs, spark, monkeypatch):
    """The stage named after SimHash takes its first groups from fingerprints, and checks them in full."""
    from bandwise.llm import simhash_dedup

    seen = []
    met = simhash_dedup.fingerprint_links
    monkeypatch.setattr(simhash_dedup, "fingerprint_links", lambda *a: seen.append(a) or met(*a))
    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(base), " ".join([*base[:399], "other"]), "one two", "two one", None, ""]
    got = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, docs(texts), "")
    assert sorted(r.doc_id for r in got.collect()) == [0, 2, 3, 4] and len(seen) == 1
