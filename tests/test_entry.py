import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from bandwise import oracle
from bandwise import queries as named
from bandwise.plans.quality import quality_by_k
from bandwise.plans.similar import similar_pairs
from bandwise.queries import embeddings

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    return con


def test_every_query_has_sql():
    assert named.queries().keys() == oracle.oracle_sql().keys()
    assert named.queries().keys() <= entry_points.queries().keys()


@pytest.mark.parametrize(
    "name", ["simhash_signature_wide", "candidate_count_wide", "near_duplicate_quality", "sweep_sparse_ids"]
)
def test_query_equals_its_sql(spark, con, name):
    ours = entry_points.queries()[name](spark, SF).toPandas()
    theirs = con.execute(entry_points.oracle_sql()[name]).df()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    ours, theirs = (x[columns].sort_values(columns, ignore_index=True) for x in (ours, theirs))
    pd.testing.assert_frame_equal(ours, theirs, rtol=0, atol=1e-9)


# Pairs, documents, mean cosine and mean angle cosine at k = 16, 20, 24.
GOLDEN = [(24, 45, 0.268256, 0.733302), (316, 350, 0.193730, 0.602066), (1310, 495, 0.143990, 0.475241)]


def test_golden_quality(spark):
    pairs = similar_pairs(embeddings(spark, SF), 64, [8], 24)
    rows = quality_by_k(pairs, [16, 20, 24], 64, [8]).orderBy("k").collect()
    got = [(r.num_pairs, r.num_docs, r.mean_cosine, r.cosine_hamming) for r in rows]
    assert np.allclose(got, GOLDEN, atol=1e-6)


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert len(rows) == 6 and sum(r.num_docs for r in rows) > 0
