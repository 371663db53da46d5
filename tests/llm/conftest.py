import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def docs(spark):
    """Turns texts into documents; ids count from 0 unless given."""

    def make(texts, ids=None, **columns):
        ids = range(len(texts)) if ids is None else ids
        extra = {c: columns.get(c, [None] * len(texts)) for c in ("lang", "source")}
        rows = [(i, t, *(extra[c][k] for c in extra), None if t is None else len(t), "x") for k, (i, t) in enumerate(zip(ids, texts))]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fingerprints string")

    return make
