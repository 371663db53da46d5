import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bandwise.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session("tests", spark__checkpoint__dir=folder, spark__driver__memory="6g", spark__sql__shuffle__partitions="3")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """Turns a matrix into ``(doc_id, vec)`` rows."""

    def make(matrix, ids=None):
        ids = range(len(matrix)) if ids is None else ids
        rows = [(int(i), None if v is None else [float(x) for x in v]) for i, v in zip(ids, matrix, strict=True)]
        return spark.createDataFrame(rows, "doc_id long, vec array<float>")

    return make


@pytest.fixture(scope="session")
def clustered():
    """Vectors with a third exact copies of one, near copies of others, and the rest apart."""
    rng = np.random.default_rng(5)
    base = rng.standard_normal((60, 16))
    copies = np.repeat(base[:1], 50, axis=0)
    near = np.repeat(base[1:11], 4, axis=0) + 0.05 * rng.standard_normal((40, 16))
    everything = np.concatenate([base, copies, near]).astype(np.float32)
    return everything[rng.permutation(len(everything))]
