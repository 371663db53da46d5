import hashlib
import zlib

import pytest
from odd import ODD
from pyspark.sql import functions as F

from bandwise.llm import merkle
from bandwise.llm.queries import op11_merkle, tampered_text


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def fold_levels(nodes):
    """All levels of a tree of ``nodes``, items first."""
    found = [nodes]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([h("".join(last[at : at + 8])) for at in range(0, len(last), 8)])
    return found


def path(levels, at):
    proof = []
    for nodes in levels[:-1]:
        start = at - at % 8
        proof.append(("".join(nodes[start:at]), "".join(nodes[at + 1 : start + 8])))
        at //= 8
    return proof


def brute(rows):
    """The manifest by its definition, for a list of (doc_id, text, lang, source, n_chars)."""
    leaves = [(d, h("".join(map(field, (d, s, la, n, t)))), la, (d, t, la, s, n)) for d, t, la, s, n in rows]
    langs = sorted({la for _, _, la, _ in leaves}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for la in langs:
        mine = sorted((x for x in leaves if x[2] == la), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[la] = (mine, fold_levels([x[1] for x in mine]))
    top = fold_levels([trees[la][1][-1][0] for la in langs])
    out = []
    for at_lang, la in enumerate(langs):
        mine, levels = trees[la]
        for at, (d, leaf, _, (doc, text, lang, source, n)) in enumerate(mine):
            proof = path(levels, at) + path(top, at_lang)
            changed = text
            if doc is not None and text is not None and zlib.crc32(str(doc).encode()) % 3 == 0:
                changed = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = h("".join(map(field, (doc, source, lang, n, changed))))
            for left, right in proof:
                node = h(left + node + right)
            out.append((d, leaf, levels[-1][0], top[-1][0], h("".join(a + b for a, b in proof)), node, node == top[-1][0]))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def run(docs):
    found = merkle.manifest(docs, tampered_text(docs))
    got = found.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.array_join(F.transform("proof", lambda s: F.concat(s["left"], s["right"])), ""), 256).alias("proof_sha256"),
        "folded_root", "verified",
    )
    return sorted((tuple(r) for r in got.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


@pytest.mark.parametrize("block_levels", [1, 3])
def test_manifest_matches_its_definition(spark, monkeypatch, block_levels):
    """Several languages with null among them, a language of one, repeated rows and ids, null ids; blocks of 8 or 512."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", block_levels)
    rows = []
    for i in range(700):
        lang = [None, "en", "de", "ß", "fr"][i % 5] if i < 600 else "en"
        rows.append((i, f"Text {i} ABC" if i % 7 else None, lang, f"s{i % 3}" if i % 11 else None, i % 13))
    rows += [rows[3], rows[3], (None, "Hello", "en", None, None), (None, None, None, None, None), (5, "Other", "de", "x", 2), (900, "Lone", "xx", None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("clash", F.lit(1))
    assert run(docs) == brute(rows)


@pytest.mark.parametrize("texts", [[], ["only"], ODD])
def test_small_tables(spark, docs, texts):
    table = docs(texts)
    rows = [(i, t, None, None, None if t is None else len(t)) for i, t in enumerate(texts)]
    assert run(table) == brute(rows)
    if texts:
        assert all(r[-1] in (True, False) for r in run(table))


def test_single_document_is_its_own_root(spark, docs):
    (row,) = run(docs(["AbC"], ids=[0]))
    assert row[1] == row[2] == row[3] and row[4] == h("")


def test_query_over_a_given_table(spark):
    """The registered query over all documents of the smallest table, against the definition."""
    import pyarrow.parquet as pq

    sf_dir = "/root/testdata/sf0.001"
    table = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text", "lang", "source", "n_chars"]).to_pylist()
    expected = brute([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in table])
    got = sorted((tuple(r) for r in op11_merkle(spark, sf_dir).collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert got == expected
